"""Whitening of embeddings: blockwise QR, bidiagonal form, singular values by dqds, directions by twisted factorisations.

Spark reduces the rows: tasks keep only a triangular factor, factors merge in groups until one is left. What reaches the
driver is d sums and one d x d triangle, d being the length of the vectors; the covariance matrix itself is never formed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches, written

SCALE, SHIFT = 64, 1_000_000
BLOCK_CELLS = 1 << 18
FAN_IN = 8
EPS = float(np.finfo(np.float64).eps)


# -- the small dense part


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reduction r = U B W': diagonal and superdiagonal of B, and the orthogonal W. ``r`` is square."""
    a, d = np.array(r, np.float64), len(r)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        top = np.abs(x).max(initial=0.0)
        if top == 0 or not np.any(x[1:]):
            return None
        v = x / top
        v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
                w[:, k + 1 :] -= 2.0 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), w


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd transform with shift; the third value is the smallest d met (negative: the shift was too large)."""
    n = len(q)
    nq, ne = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        nq[i] = d + e[i]
        if nq[i] == 0.0:
            ne[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / nq[i]
            ne[i], d = e[i] * ratio, d * ratio - shift
        least = min(least, d)
    nq[n - 1] = d
    return nq, ne, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by the dqds algorithm with deflation.

    Transforms without subtraction keep relative accuracy; a shift is used only if it leaves all d positive.
    """
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    out, blocks = [], [(q, e, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            n = len(q)
            if n == 1:
                out.append(max(q[0], 0.0) + moved)
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS**2 * max(q[i], q[i + 1], moved * EPS)), None)
            if cut == n - 2:
                out.append(max(q.pop(), 0.0) + moved)
                e.pop()
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # the large end first, so that the small values come out at the bottom
                q, e = q[::-1], e[::-1]  # the mirror image has the same singular values
            # the last two rows give an estimate from above; halve it until the transform stays positive
            trial = _smaller(q[-2], e[-1], q[-1])
            for _ in range(6):
                nq, ne, least = _dqds(q, e, trial)
                if least >= 0:
                    break
                trial = max(0.0, trial + least) if trial + least > 0.1 * trial else trial * 0.25
            else:
                trial = 0.0
                nq, ne, least = _dqds(q, e, 0.0)
            if trial <= EPS * moved * 0.01:
                trial = 0.0
                nq, ne, _ = _dqds(q, e, 0.0)
            q, e, moved = nq, ne, moved + trial
    return np.array(sorted(out, reverse=True))


def _smaller(a: float, b: float, c: float) -> float:
    """Smaller eigenvalue of the last 2 x 2 block of a qd array (trace a + b + c, determinant a * c), as a shift."""
    trace, product = a + b + c, a * c
    root = math.sqrt(max(trace * trace / 4 - product, 0.0))
    return product / (trace / 2 + root) if trace > 0 else 0.0


def _factors(q: np.ndarray, e: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stationary and progressive qd transforms of B'B - value, ``q`` and ``e`` being the squares of B's entries:
    multipliers from the top and from the bottom, and the twist at each place."""
    n, tiny = len(q), np.finfo(np.float64).tiny ** 0.5
    off = np.sqrt(q[:-1] * e)  # off-diagonal of B'B up to sign
    top, bottom = np.empty(n - 1), np.empty(n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        top[i] = off[i] / pivot
        s[i + 1] = (e[i] / pivot) * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        bottom[i] = off[i] / pivot
        p[i] = (q[i] / pivot) * p[i + 1] - value
    return top, bottom, s + p + value


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for one eigenvalue from the twisted factorisation with the smallest twist."""
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    q, e = diagonal**2, above**2
    top, bottom, twist = _factors(q, e, value)
    r = int(np.argmin(np.abs(twist)))
    sign = np.sign(diagonal[:-1] * above)
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -sign[i] * top[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -sign[i] * bottom[i] * z[i]
    top_entry = np.abs(z).max()
    z /= top_entry
    return z / np.linalg.norm(z)


def _solve(diagonal: np.ndarray, above: np.ndarray, value: float, b: np.ndarray) -> np.ndarray:
    """x of (B'B - value) x = b by elimination with partial pivoting of the tridiagonal matrix."""
    n = len(diagonal)
    main = diagonal**2 - value
    main[1:] += above**2
    off = diagonal[:-1] * above
    floor = EPS * float((diagonal**2).max() + (above**2).max(initial=0.0))
    a, c, c2, x = main.copy(), np.append(off, 0.0), np.zeros(n), np.array(b, np.float64)
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(a[i]):
            a[i], low = low, a[i]
            c[i], a[i + 1] = a[i + 1], c[i]
            c2[i], c[i + 1] = c[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        pivot = a[i] if abs(a[i]) > floor else floor
        a[i] = pivot
        f = low / pivot
        a[i + 1] -= f * c[i]
        c[i + 1] -= f * c2[i]
        x[i + 1] -= f * x[i]
    if abs(a[-1]) <= floor:
        a[-1] = floor
    x[-1] /= a[-1]
    for i in range(n - 2, -1, -1):
        x[i] = (x[i] - c[i] * x[i + 1] - (c2[i] * x[i + 2] if i + 2 < n else 0.0)) / a[i]
    return x


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B as columns, one per value (falling).

    Values that agree to 1e-3 form a cluster. There a twisted vector may point near its neighbours', so its part along
    the earlier ones of the cluster is taken off, and inverse iteration restores it, from a fixed start if little is left.
    """
    n = len(diagonal)
    out = np.zeros((n, len(values)))
    starts = np.random.default_rng(5)
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * values[k - 1]:
            first = k
        z = twisted_vector(diagonal, above, value)
        near = out[:, first:k]
        if k > first:
            for attempt in range(8):
                for _ in range(2):
                    z = z - near @ (near.T @ z)
                size = float(np.linalg.norm(z))
                z = z / size if size > 1e-8 else starts.normal(size=n)
                if attempt and size > 0.5:
                    break
                z = _solve(diagonal, above, float(value), z)
                z /= np.linalg.norm(z)
            for _ in range(2):
                z = z - near @ (near.T @ z)
            z /= np.linalg.norm(z)
        out[:, k] = z
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: rows, exact sums, unit directions (columns), eigenvalues and the trace of the covariance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    trace: float


# -- Spark


def usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """(id, vec) of the rows whose vector is not null, not empty and free of null, NaN and infinite entries."""
    chosen = vectors.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return chosen.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The integer vectors of a batch, n x d."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, d) + SHIFT


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n from the exact integer n * x - sums, rounded once."""
    return (x * n - sums) / n


def _common_length(rows: DataFrame) -> int:
    """The vectors' length; if they differ, the most frequent one, the longer at a tie. No rows: 0."""
    top = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top.d if top else 0


def _sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    def run(batches):
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, total = n + len(x), total + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([*range(d), -1], pa.int32()), pa.array([*total.tolist(), n], pa.int64())], names=["place", "part"])

    parts = rows.select("vec").mapInArrow(run, "place int, part bigint").groupBy("place").agg(F.sum("part").alias("total")).collect()
    by = {r.place: r.total for r in parts}
    return by.get(-1, 0), np.array([by.get(i, 0) for i in range(d)], np.int64)


def _stacked(blocks: np.ndarray, r: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([r, blocks]), mode="r")


def _triangle(rows: DataFrame, d: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred rows: each task folds its rows into one factor block by block; factors merge ``FAN_IN`` at a time."""
    high = max(d, BLOCK_CELLS // d)

    def reduce(batches):
        r, count = np.zeros((0, d)), 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for k in range(0, len(x), high):
                r = _stacked(_centred(x[k : k + high], n, sums), r)
            count += len(x)
        if count:
            yield _packed(r)

    def _packed(r):
        square = np.zeros((d, d))
        square[: len(r)] = r
        return pa.RecordBatch.from_arrays([pa.array([square.tobytes()], pa.binary())], names=["r"])

    def merge(batches):
        r = np.zeros((0, d))
        for batch in batches:
            for cell in batch.column(0):
                r = _stacked(np.frombuffer(cell.as_buffer(), np.float64).reshape(d, d), r)
        if len(r):
            yield _packed(r)

    factors = written(rows.select("vec").mapInArrow(reduce, "r binary"), "factors")
    left = factors.count()
    while left > 1:
        left = -(-left // FAN_IN)
        factors = written(factors.repartition(left).mapInArrow(merge, "r binary"), "factors")
        left = factors.count()
    top = factors.first()
    return np.frombuffer(top.r, np.float64).reshape(d, d) if top else np.zeros((d, d))


def solve(r: np.ndarray, n: int, sums: np.ndarray, most: int) -> Whitening:
    """The transform from the triangular factor. Directions without variance (to rounding) are left out."""
    diagonal, above, w = bidiagonal(r)
    squares = squared_singular_values(diagonal, above)
    kept = squares[: min(most, len(squares))]
    kept = kept[kept > (EPS * max(len(r), 16)) ** 2 * squares[0]] if squares[0] > 0 else kept[:0]
    found = w @ directions(diagonal, above, kept)
    return Whitening(n, sums, found, kept / n, float(squares.sum()) / n)


def fit(rows: DataFrame, d: int, most: int = 32) -> Whitening:
    """Fit on all of ``rows`` (from ``usable``, vectors of length ``d``)."""
    n, sums = _sums(rows, d)
    if not n:
        return Whitening(0, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    return solve(_triangle(rows, d, n, sums), n, sums, most)


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (_centred(x, model.n, model.sums) @ model.directions) / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows.

    Tasks return sums over their rows centred on a common origin (the whitened mean, zero up to rounding), added up in Spark.
    """
    d, k = model.directions.shape
    if not k or not model.n:
        return 0.0

    def run(batches):
        gram, total = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = _project(_matrix(batch.column(0), d), model)
            gram, total = gram + w.T @ w, total + w.sum(axis=0)
        cells = np.concatenate([gram.ravel(), total])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], names=["place", "part"])

    parts = rows.select("vec").mapInArrow(run, "place int, part double").groupBy("place").agg(F.sum("part").alias("total")).collect()
    cells = np.zeros(k * k + k)
    for r in parts:
        cells[r.place] = r.total
    mean = cells[k * k :] / model.n
    return float(np.abs(cells[: k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - sums)^2 per row, exact: 64-bit where it surely fits, whole numbers of any size otherwise."""
    apart = x * n - sums
    limit = math.isqrt((1 << 63) // max(apart.shape[1], 1)) - 1
    if not apart.size or int(np.abs(apart).max()) <= limit:
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in apart.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whitened(vectors: DataFrame, most: int = 32, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row a list of its whitened values: id, n, deviation, values, and the transform's explained shares and identity_error.

    Fitted on all usable rows: vectors that are not null or empty and hold no null, NaN or infinite entry. If lengths
    differ, only the most frequent length is used. Null or repeated ids are rows like any other, further columns play no
    part, an empty table gives no rows, a table without variance gives rows with empty lists. A deviation beyond 64 bits is null.
    """
    bound_batches(vectors.sparkSession)
    rows = usable(vectors, ident, vector)
    d = _common_length(rows)
    rows = rows.where(F.size("vec") == d)
    model = fit(rows, d, most)
    error = identity_error(rows, model)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            w = _project(x, model)
            k = w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * k), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviations(x, model.n, model.sums), pa.int64()), lists], names=["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>")
    shares = F.array(*[F.lit(float(v) / model.trace) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    return out.select(
        F.col("id").alias(ident), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        shares.alias("explained"), F.lit(error).alias("identity_error"),
    )


def components(white: DataFrame, ident: str = "vec_id") -> DataFrame:
    """One row per vector and component, numbered from 1 by falling eigenvalue."""
    spread = white.select(ident, "n", "deviation", "identity_error", "explained", F.posexplode("whitened").alias("_place", "_value"))
    return spread.select(
        ident, (F.col("_place") + 1).alias("component"), "n", "deviation", F.col("_value").alias("whitened"),
        F.get("explained", F.col("_place")).alias("explained"), "identity_error",
    )

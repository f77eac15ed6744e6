"""Approximate nearest neighbours: NN-descent builds a graph, queries search it greedily.

The graph starts from cells around leaders drawn from the nodes: each node is in the cells of its nearest leaders, and
cells are compared whole, so that a larger table starts about as well as a small one and needs few rounds. Then each round
joins every node with its neighbours in both directions and lets these meet: neighbours of neighbours that are nearer
than what a node has replace it. A meeting keeps the vectors of those at it, so a round joins only the fresh neighbours. Inner products are made comparable by one more coordinate that gives all vectors the
same length. Equal vectors are one node. Rows carry packed arrays, so numpy works on blocks inside Spark's tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches, grouped, written, written_alone

#: Neighbours kept for a node; reverse ones that join in; cells that a node is in, rows in a block; width of a search.
NEIGHBOURS, REVERSE, TABLES, BLOCK, BEAM = 32, 32, 10, 2048, 160
#: Blocks that a cell of the first graph may hold; leaders at most, those of the second set apart.
CELL, LEADERS = 4, 4096
#: Rounds go on until one has changed less than this share of all neighbours.
CHANGED = 0.01
_LIST = "id bigint, near binary, score binary, fresh binary"
#: What a meeting keeps of those that meet, and the mark of one that came in as a neighbour only.
_HELD = ("near", "code", "scale", "bar", "mark")
_MEETING = "id bigint, near binary, code binary, scale binary, bar binary, mark binary, fresh binary"
_NO_MARK = 2**63 - 1
#: Offers that a task merges before it sends them.
HELD = 1 << 20
#: Queries that meet one block of nodes in one task.
ASKED = 8192


def _f8(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), np.float64)


def _sorted_by(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(key).sortWithinPartitions(key)


def _pick(owner: np.ndarray, near: np.ndarray, score: np.ndarray, fresh: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Per owner the ``keep`` best distinct (near, score, fresh), best first, ties to the smaller id. A pair that is met
    several times has its best score, and is fresh only if it is so everywhere."""
    order = np.lexsort((-score, near, owner))
    owner, near, score, fresh = owner[order], near[order], score[order], fresh[order]
    once = np.ones(len(owner), bool)
    once[1:] = (owner[1:] != owner[:-1]) | (near[1:] != near[:-1])
    at = np.flatnonzero(once)
    owner, near, score, fresh = owner[at], near[at], score[at], np.minimum.reduceat(fresh, at) if len(at) else fresh
    order = np.lexsort((near, -score, owner))
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)  # owners are sorted alike in both orders
    own = order[rank < keep]
    return owner[own], near[own], score[own], fresh[own]


def _unpack(table: pa.Table):
    lists = [np.frombuffer(x.as_buffer(), np.int64) for x in table.column("near")]
    scores = [np.frombuffer(x.as_buffer(), np.float32) for x in table.column("score")]
    marks = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("fresh")]
    owner = np.repeat(table.column("id").to_numpy(), [len(x) for x in lists])
    return owner, np.concatenate(lists), np.concatenate(scores).astype(np.float64), np.concatenate(marks)


def _pack(owner: np.ndarray, near: np.ndarray, score: np.ndarray, fresh: np.ndarray) -> pa.RecordBatch:
    ids, at = np.unique(owner, return_index=True)
    ends = np.append(at[1:], len(owner))
    values = [near.astype(np.int64), score.astype(np.float32), fresh.astype(np.uint8)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), *[pa.array([v[i:j].tobytes() for i, j in zip(at, ends, strict=True)], pa.binary()) for v in values]],
        names=["id", "near", "score", "fresh"],
    )


def _best(lists: DataFrame, keep: int) -> DataFrame:
    """Merge rows of lists into one row per id."""

    def run(batches):
        for table in grouped(batches):
            yield _pack(*_pick(*_unpack(table), keep))

    return _sorted_by(lists, "id").mapInArrow(run, _LIST)


def nodes(rows: DataFrame, vector: str, id_col: str) -> DataFrame:
    """(id, vec) of the distinct usable vectors, packed as doubles; the id is the smallest of the equal rows."""
    usable = rows.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = "forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)"
    return usable.where(fine)


def _packed(df: DataFrame, column: str, out: str, others: list[str]) -> DataFrame:
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in others)

    def run(batches):
        for batch in batches:
            raw = batch.column(len(others))
            data = [np.asarray(x.values, np.float64).tobytes() for x in raw]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(others))], pa.array(data, pa.binary())], names=[*others, out])

    return df.select(*others, column).mapInArrow(run, f"{kinds}, {out} binary")


def leaders(vectors: DataFrame, count: int, longest: float, dims: int, some: int) -> np.ndarray:
    """``some`` nodes chosen by hash, lengthened; all of them if there are not more."""
    share = some + 4 * math.sqrt(some) + 8  # of this many on average, so that ``some`` are found
    found = vectors.select(F.pmod(F.xxhash64("id"), F.lit(max(count, 1))).alias("h"), "id", "vec").where(F.col("h") < share).collect()
    found = sorted(found, key=lambda r: (r.h, r.id))[:some]
    return _lengthened(np.array([np.frombuffer(r.vec) for r in found]).reshape(-1, dims), longest).astype(np.float32)


def start(vectors: DataFrame, count: int, longest: float, dims: int, keep: int = NEIGHBOURS, tables: int = TABLES, block: int = BLOCK) -> DataFrame:
    """The first graph: the best neighbours within cells around leaders. A node is in the cells of its ``tables`` nearest
    leaders, and a cell is compared whole, in strips with as many scores as a block would have.

    There are as many leaders as cells are needed, up to ``LEADERS``; beyond that a second set divides each cell. A cell
    with too many rows all the same is dealt out to several at random, so none grows with the data.
    """
    cell = CELL * block
    parts = max(1, math.ceil(count / (0.75 * cell)))
    tables = tables if parts > 1 else 1
    first = max(tables, min(parts * tables, LEADERS))
    second = min(math.ceil(parts * tables / first), LEADERS)
    lead = leaders(vectors, count, longest, dims, first + second) if parts > 1 else np.zeros((1, dims + 1), np.float32)
    firsts, seconds = lead[:first], lead[first:] if second > 1 and len(lead) > first else lead[:1]
    tables = min(tables, len(firsts))

    def codes(batches):
        for batch in batches:
            full = _lengthened(np.stack([_f8(x) for x in batch.column(1)]), longest) if batch.num_rows else np.zeros((0, dims + 1))
            full = full.astype(np.float32)
            small = pa.array([x.tobytes() for x in full], pa.binary())
            near = np.argpartition(-(full @ firsts.T), tables - 1, axis=1)[:, :tables] * len(seconds) + (full @ seconds.T).argmax(axis=1)[:, None]
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(near[:, t].astype(np.int64)), batch.column(0), small], names=["code", "id", "vec"])

    coded = written(vectors.mapInArrow(codes, "code bigint, id bigint, vec binary"), "codes")
    sizes = coded.groupBy("code").agg(F.ceil(F.count("*") / cell).cast("int").alias("split"))
    dealt = coded.join(sizes, "code").withColumn("code", F.xxhash64("code", F.pmod(F.xxhash64("id", "code"), F.col("split"))))

    def within(batches):
        for table in grouped(batches):
            code = table.column("code").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, code[1:] != code[:-1])), len(code))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                ids = table.column("id").slice(a, b - a).to_numpy()
                x = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in table.column("vec").slice(a, b - a)])
                few = min(keep, len(ids) - 1)
                if few < 1:
                    continue
                high = max(1, block * block // len(ids))
                for i in range(0, len(ids), high):
                    s = x[i : i + high] @ x.T
                    s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
                    top = np.argpartition(-s, few - 1, axis=1)[:, :few]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[i : i + high]), pa.array([n.tobytes() for n in ids[top]], pa.binary()),
                            pa.array([n.tobytes() for n in np.take_along_axis(s, top, 1)], pa.binary()), pa.array([b"\1" * few] * len(s), pa.binary()),
                        ],
                        names=["id", "near", "score", "fresh"],
                    )

    return _best(_sorted_by(dealt, "code").mapInArrow(within, _LIST), keep)


def _lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1) / longest


def edges(graph: DataFrame, reverse: int = REVERSE) -> DataFrame:
    """(id, near, fresh): neighbours in both directions, of the reverse ones ``reverse`` at most, chosen by hash."""

    def flat(batches):
        for batch in batches:
            if batch.num_rows:
                owner, near, _, fresh = _unpack(pa.Table.from_batches([batch]))
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(near), pa.array(fresh > 0)], names=["id", "near", "fresh"])

    forward = written(graph.mapInArrow(flat, "id bigint, near bigint, fresh boolean"), "edges")
    order = Window.partitionBy("near").orderBy(F.xxhash64("id", "near"), "id")
    back = forward.withColumn("r", F.row_number().over(order)).where(f"r <= {reverse}").select(F.col("near").alias("id"), F.col("id").alias("near"), "fresh")
    return forward.union(back).groupBy("id", "near").agg(F.max("fresh").alias("fresh"))


def coded(vectors: DataFrame, longest: float) -> DataFrame:
    """(near, code, scale): vectors as signed bytes, as only the order of scores matters while the graph is built."""

    def run(batches):
        for batch in batches:
            full = _lengthened(np.stack([_f8(x) for x in batch.column(1)]), longest) if batch.num_rows else np.zeros((0, 1))
            scale = np.abs(full).max(axis=1, initial=1e-9) / 127
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in np.rint(full / scale[:, None]).astype(np.int8)], pa.binary()), pa.array(scale.astype(np.float32))],
                names=["near", "code", "scale"],
            )

    return vectors.mapInArrow(run, "near bigint, code binary, scale float")


def _all(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind)


def meetings(graph: DataFrame, codes: DataFrame, held: DataFrame | None = None, keep: int = NEIGHBOURS, reverse: int = REVERSE) -> DataFrame:
    """Per node one row of those that meet there: its neighbours, and the ``reverse`` nodes of smallest hash that have had
    it as theirs. With the meetings ``held`` in the last round only fresh neighbours fetch their codes; all others are there."""

    later = held is not None

    def flat(batches):
        for batch in batches:
            if batch.num_rows:
                owner, near, _, fresh = _unpack(pa.Table.from_batches([batch]))
                some = (fresh > 0) | (not later)
                yield pa.RecordBatch.from_arrays([pa.array(owner[some]), pa.array(near[some]), pa.array(fresh[some] > 0)], names=["id", "near", "fresh"])

    def worst(batches):
        for batch in batches:
            low = [s[-1] if len(s) >= keep else -np.inf for s in (np.frombuffer(x.as_buffer(), np.float32) for x in batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(low, pa.float32())], names=["near", "bar"])

    forward = written(graph.mapInArrow(flat, "id bigint, near bigint, fresh boolean"), "edges").withColumn("mark", F.xxhash64("id", "near"))
    order = Window.partitionBy("near").orderBy("mark", "id")
    back = forward.withColumn("r", F.row_number().over(order)).where(f"r <= {reverse}").select(F.col("near").alias("id"), F.col("id").alias("near"), "fresh", "mark")
    both = forward.withColumn("mark", F.lit(_NO_MARK)).unionByName(back)
    fetched = both.join(codes, "near").join(graph.mapInArrow(worst, "near bigint, bar float"), "near", "left")
    fetched = fetched.select("id", "near", "fresh", "mark", "code", "scale", F.coalesce("bar", F.lit(float("-inf")).cast("float")).alias("bar"))
    rows = fetched.unionByName(graph.select("id", F.col("near").alias("own")), allowMissingColumns=True)
    old = held if held is not None else graph.sparkSession.createDataFrame([], _MEETING)
    rows = rows.unionByName(old.select("id", *(F.col(c).alias(f"{c}_") for c in _HELD)), allowMissingColumns=True)
    rows = rows.select("id", "near", "fresh", "mark", "code", "scale", "bar", "own", *(f"{c}_" for c in _HELD))

    def gather(batches):
        for table in grouped(batches):
            before, new, own = (table.filter(table.column(c).is_valid()) for c in ("near_", "near", "own"))
            sizes = [[len(x.as_buffer()) // 8 for x in t.column(c)] for t, c in ((before, "near_"), (own, "own"))]
            n = (sum(sizes[0]), new.num_rows, sum(sizes[1]))
            if not n[0] + n[1]:
                continue
            node = np.concatenate([np.repeat(before.column("id").to_numpy(), sizes[0]), new.column("id").to_numpy(), np.repeat(own.column("id").to_numpy(), sizes[1])])
            near = np.concatenate([_all(before.column("near_"), np.int64), new.column("near").to_numpy(), _all(own.column("own"), np.int64)])
            source = np.repeat(np.arange(3), n)
            code = np.concatenate([_all(before.column("code_"), np.int8), _all(new.column("code"), np.int8)]).reshape(n[0] + n[1], -1)
            scale = np.concatenate([_all(before.column("scale_"), np.float32), new.column("scale").to_numpy()])
            bar = np.concatenate([_all(before.column("bar_"), np.float32), new.column("bar").to_numpy(), np.full(n[2], -np.inf, np.float32)])
            mark = np.concatenate([_all(before.column("mark_"), np.int64), new.column("mark").to_numpy(), np.full(n[2], _NO_MARK)])
            fresh = np.concatenate([np.zeros(n[0], bool), new.column("fresh").to_numpy(zero_copy_only=False).astype(bool), np.zeros(n[2], bool)])

            # one entry per node and other node: its code from where it came in first, its lowest mark, its latest bar
            order = np.lexsort((source, near, node))
            node, near, source = node[order], near[order], source[order]
            once = np.ones(len(node), bool)
            once[1:] = (node[1:] != node[:-1]) | (near[1:] != near[:-1])
            at = np.flatnonzero(once)
            node, near, first, where = node[at], near[at], source[at], order[at]
            known = np.logical_or.reduceat(source == 2, at)
            mark, bar = np.minimum.reduceat(mark[order], at), np.maximum.reduceat(bar[order], at)
            fresh = np.logical_or.reduceat(fresh[order], at) & (first == 1)
            ranked = np.lexsort((near, mark, node))
            rank = np.empty(len(node), np.int64)
            rank[ranked] = np.arange(len(node)) - np.searchsorted(node, node)
            some = np.flatnonzero((first < 2) & (known | ((mark != _NO_MARK) & (rank < reverse))))
            if not len(some):
                continue
            ids, starts = np.unique(node[some], return_index=True)
            ends, where = np.append(starts[1:], len(some)), where[some]
            values = (near[some], code[where], scale[where], bar[some], mark[some], fresh[some].astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), *(pa.array([v[i:j].tobytes() for i, j in zip(starts, ends, strict=True)], pa.binary()) for v in values)], names=["id", *_HELD, "fresh"]
            )

    return _sorted_by(rows, "id").mapInArrow(gather, _MEETING)


def meet(graph: DataFrame, held: DataFrame, keep: int = NEIGHBOURS, offer: int = 6) -> DataFrame:
    """The graph after all meetings: each node is offered those of the others at a meeting that beat its worst neighbour.

    Two of them meet only if one is fresh there, that is, came in with the last round; all others have met.
    """

    def run(batches):
        out, count = ([], [], []), 0

        def merged():
            owner, other, value = (np.concatenate(o) for o in out)
            return _pack(*_pick(owner, other, value, np.ones(len(owner), np.uint8), keep))

        for batch in batches:
            for row in zip(*(batch.column(c) for c in (*_HELD, "fresh")), strict=True):
                near, code, scale, bar, _, new = (np.frombuffer(x.as_buffer(), k) for x, k in zip(row, (np.int64, np.int8, np.float32, np.float32, np.int64, np.bool_), strict=True))
                few = min(offer, len(near) - 1)
                if few < 1 or not new.any():
                    continue
                x = code.reshape(len(near), -1).astype(np.float32) * scale[:, None]
                s = x @ x.T
                s[~(new[:, None] | new[None])] = -np.inf  # these two have met
                np.fill_diagonal(s, -np.inf)
                top = np.argpartition(-s, few - 1, axis=1)[:, :few]
                value = np.take_along_axis(s, top, 1)
                good = value > np.maximum(bar[:, None], np.float32(-3e38))
                out[0].append(np.repeat(near, good.sum(axis=1)))
                out[1].append(near[top[good]])
                out[2].append(value[good])
                count += len(out[0][-1])
                if count >= HELD:
                    yield merged()
                    out, count = ([], [], []), 0
        if count:
            yield merged()

    def met(batches):
        for batch in batches:
            seen = pa.array([bytes(len(x.as_buffer()) // 8) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], seen], names=["id", "near", "score", "fresh"])

    return _best(graph.mapInArrow(met, _LIST).union(held.mapInArrow(run, _LIST)), keep)


def descend(graph: DataFrame, vectors: DataFrame, longest: float, keep: int = NEIGHBOURS, offer: int = 6) -> DataFrame:
    """One round by itself."""
    return meet(graph, meetings(graph, coded(vectors, longest), keep=keep), keep, offer)


def changed(graph: DataFrame) -> float:
    """The share of fresh neighbours: those that the last round brought in."""

    def fresh(batches):
        for batch in batches:
            marks = [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(m.sum()) for m in marks], pa.int64()), pa.array([len(m) for m in marks], pa.int64())], names=["fresh", "size"])

    seen = graph.select("fresh").mapInArrow(fresh, "fresh bigint, size bigint").agg(F.sum("fresh"), F.sum("size")).first()
    return (seen[0] or 0) / max(seen[1] or 0, 1)


def build(vectors: DataFrame, keep: int = NEIGHBOURS, bound: float = CHANGED) -> DataFrame:
    """The neighbour graph (id, near, score) over nodes (id, vec); every node is in it."""

    def size(batches):
        for batch in batches:
            x = [_f8(v) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([float(v @ v) for v in x], pa.float64()), pa.array([len(v) for v in x], pa.int64())], names=["square", "dims"])

    seen = vectors.mapInArrow(size, "square double, dims bigint").agg(F.count("*").alias("n"), F.max("square").alias("longest"), F.max("dims").alias("dims")).first()
    longest = math.sqrt(seen.longest) if seen.n else 1.0
    bound_batches(vectors.sparkSession)
    graph, codes, held = written(start(vectors, seen.n, longest, int(seen.dims or 0), keep), "graph"), written(coded(vectors, longest), "vectors"), None
    share = 1.0 if seen.n > keep + 1 else 0.0
    while share >= bound:  # ends, as lists only improve
        held = written_alone(meetings(graph, codes, held, keep), "meetings")
        graph = written_alone(meet(graph, held, keep), "graph")
        share = changed(graph)
    return graph


def search(queries: DataFrame, graph: DataFrame, vectors: DataFrame, beam: int = BEAM, block: int = 4 * BLOCK) -> DataFrame:
    """Greedy search for queries (q, qvec, at): from node ``at`` on, all nodes of the beam are expanded until none is
    new. Returns (q, near, score): the beam as packed lists, best first, with inner products in double precision.

    Scores are computed where the candidates' vectors are: a block of nodes meets the queries that ask for it, so
    neither vectors nor pairs of vectors are copied per candidate.
    """
    count = vectors.count()
    blocks = max(1, math.ceil(count / block))
    placed = written(vectors.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks))), "placed")
    links = written(edges(graph).select(F.col("id").alias("node"), "near"), "links")
    salts = max(1, math.ceil(queries.count() / ASKED))
    copies = placed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def ask(found: DataFrame) -> DataFrame:
        """(q, qvec, id): score each once and return lists per query and block."""
        wanted = found.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks))).groupBy("b", "q").agg(F.collect_set("id").alias("ids"))
        wanted = wanted.join(queries.select("q", "qvec"), "q").withColumn("salt", F.pmod(F.xxhash64("q"), F.lit(salts)).cast("int"))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = {"q": [], "near": [], "score": []}
            if left.num_rows and right.num_rows:
                ids = right.column("id").to_numpy()
                order = np.argsort(ids)
                ids, x = ids[order], np.stack([_f8(v) for v in right.column("vec")])[order]
                for q, vec, asked in zip(left.column("q").to_pylist(), left.column("qvec"), left.column("ids"), strict=True):
                    near = np.asarray(asked.values, np.int64)
                    score = x[np.searchsorted(ids, near)] @ _f8(vec)
                    best = np.lexsort((near, -score))[:beam]
                    out["q"].append(q)
                    out["near"].append(near[best].tobytes())
                    out["score"].append(score[best].tobytes())
            return pa.table({"q": pa.array(out["q"], pa.int64()), "near": pa.array(out["near"], pa.binary()), "score": pa.array(out["score"], pa.binary())})

        return wanted.groupBy("b", "salt").cogroup(copies.groupBy("b", "salt")).applyInArrow(run, "q bigint, near binary, score binary")

    def merge(batches):
        """Lists of one query, old (with the nodes expanded so far) and new: the best ``beam`` and what is not expanded."""
        for table in grouped(batches):
            q = table.column("q").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, q[1:] != q[:-1])), len(q))
            out = ([], [], [], [])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(a, b - a)
                near = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in part.column("near")])
                score = np.concatenate([_f8(x) for x in part.column("score")])
                done = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in part.column("done")])
                near, first = np.unique(near, return_index=True)
                best = np.lexsort((near, -score[first]))[:beam]
                near, score = near[best], score[first][best]
                for k, value in enumerate((int(q[a]), near.tobytes(), score.tobytes(), near[np.isin(near, done)].tobytes())):
                    out[k].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *[pa.array(o, pa.binary()) for o in out[1:]]], names=["q", "near", "score", "done"])

    def frontier(batches):
        for batch in batches:
            for q, near, done in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3), strict=True):
                new = np.setdiff1d(np.frombuffer(near.as_buffer(), np.int64), np.frombuffer(done.as_buffer(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(new), q, np.int64)), pa.array(new)], names=["q", "node"])

    def expanded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], batch.column(1)], names=["q", "near", "score", "done"])

    state = "q bigint, near binary, score binary, done binary"
    found = ask(queries.select("q", F.col("at").alias("id"))).withColumn("done", F.lit(b""))
    beams = written(_sorted_by(found, "q").mapInArrow(merge, state), "beams")
    while True:
        new = written(beams.mapInArrow(frontier, "q bigint, node bigint"), "frontier")
        if not new.head(1):
            return beams.select("q", "near", "score")
        more = ask(new.join(links, "node").select("q", F.col("near").alias("id"))).withColumn("done", F.lit(b""))
        beams = written(_sorted_by(beams.mapInArrow(expanded, state).union(more), "q").mapInArrow(merge, state), "beams")


def nearest(rows: DataFrame, queries: F.Column, k: int = 20, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The ``k`` rows of largest inner product for each row that meets ``queries``, itself left out.

    Returns (query_id, rank, id, score), best first, ties to the smaller id; fewer than ``k`` if there are not more.
    Vectors that are null, zero, or hold a null or a value that is not finite take no part, neither do rows without
    an id. Equal vectors share one node of the graph; the first k+1 of them by id are expanded at the end, as no more
    can be among k. Rows that repeat an id and vector count once. All vectors have one length. Extra columns are not read.
    """
    usable = written(nodes(rows, vector, id_col).distinct(), "usable")
    classed = usable.groupBy("v").agg(F.min("id").alias("rep"))
    vectors = written(_packed(classed.withColumnRenamed("rep", "id"), "v", "vec", ["id"]), "nodes")
    graph = build(vectors)
    asked = usable.where(queries_on(queries)).join(classed, "v")
    ready = written(_packed(asked.select(F.col("id").alias("q"), F.col("rep").alias("at"), "v"), "v", "qvec", ["q", "at"]), "queries")
    beams = search(ready, graph, vectors)

    def flat(batches):
        for batch in batches:
            for q, near, score in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                ids, values = np.frombuffer(near.as_buffer(), np.int64), _f8(score)
                least = values[min(k, len(values) - 1)]
                own = values >= least  # ties with the last are decided after equal vectors are expanded
                yield pa.RecordBatch.from_arrays([pa.array(np.full(int(own.sum()), q)), pa.array(ids[own]), pa.array(values[own])], names=["query_id", "rep", "score"])

    first = Window.partitionBy("v").orderBy("id")
    member = usable.withColumn("r", F.row_number().over(first)).where(f"r <= {k + 1}").join(classed, "v").select("rep", "id")
    found = beams.mapInArrow(flat, "query_id bigint, rep bigint, score double").join(member, "rep").where("query_id <> id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}").select("query_id", "rank", F.col("id").alias(id_col), "score")


def queries_on(condition: F.Column | str):
    """The condition may be a column or SQL text over ``id``."""
    return F.expr(condition) if isinstance(condition, str) else condition

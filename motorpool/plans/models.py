"""Fitting, calibration, scoring and labelled augmentation as Spark jobs.

Fitted models are a few numbers per module and feature, so they live on the driver and enter
later plans as literals; only sums over the data are collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.functions import hashing, numeric, scoring
from motorpool.functions.keys import null_safe_join
from motorpool.operators import windows as W
from motorpool.operators.quantiles import exact_percentiles
from motorpool.operators.series import BROADCAST_ROWS, Series, run_count
from motorpool.operators.validate import sensor_policy
from motorpool.session import cut, stored

SEQUENCE_LENGTH = 30
TOP_RESIDUALS = 8
ERROR_PROBS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p99_5": 0.995, "max": 1.0}
DENSITY_PROBS = {"p05": 0.05, "min": 0.0}


@dataclass
class Scaler:
    features: list[str]
    mean: dict[str, float]
    std: dict[str, float]
    rows: int = 0

    def scaled(self, f: str) -> Column:
        return numeric.standard_scale(F.col(f), F.lit(float(self.mean[f])), F.lit(float(self.std[f])))

    def apply(self, df: DataFrame, prefix: str = "z_") -> DataFrame:
        return df.withColumns({f"{prefix}{f}": self.scaled(f) for f in self.features})


def scaler_stats(df: DataFrame, module: str, features: list[str]) -> DataFrame:
    """Mean and population deviation per (module, feature), features sorted."""
    names = sorted(features)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.avg(f).alias("mean"), F.stddev_pop(f).alias("std")) for f in names])
    return df.groupBy(module).agg(pairs.alias("s")).select(module, F.explode("s").alias("s")).select(module, "s.*")


def fit_scaler(df: DataFrame, features: list[str]) -> Scaler:
    names = sorted(features)
    row = df.agg(F.count("*").alias("n"), *[F.avg(f).alias(f"m_{f}") for f in names], *[F.stddev_pop(f).alias(f"s_{f}") for f in names]).first()
    return Scaler(names, {f: row[f"m_{f}"] or 0.0 for f in names}, {f: row[f"s_{f}"] or 0.0 for f in names}, row["n"])


# Training rows in a partition; a table of any size has at least so many partitions.
_PART_ROWS, _PARTS = 250_000, 8


def even_out(df: DataFrame, rows: int) -> DataFrame:
    """Rows dealt out by their values and sorted: a fit starts from the same partitions whatever the cores or files."""
    parts = max(_PARTS, -(-rows // _PART_ROWS))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` on the executors' disks: a fit plans its input for every summary, and each plan would make the rows anew."""
    df = df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        df.unpersist()


# -- reconstruction error -----------------------------------------------------------------


def fit_components(scaled: DataFrame, features: list[str], k: int) -> list[list[float]]:
    """Principal components of the scaled rows, one list per feature (distributed covariance)."""
    from pyspark.ml.feature import PCA, VectorAssembler

    vec = VectorAssembler(inputCols=[f"z_{f}" for f in features], outputCol="_v").transform(scaled).select("_v")
    pc = PCA(k=k, inputCol="_v", outputCol="_p").fit(vec).pc.toArray()
    return [[float(x) for x in row] for row in pc]


def by_sensors(df: DataFrame, keys: list[str], features: list[str], most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows to score, rows set apart): a key without any value of a feature lacks that sensor.

    Keys that lack more than ``most`` are set apart whole; the others get the sensors they lack as the array
    ``masked``. Both frames have it, and ``action``: ok, mask or abort. NULL is a key.
    """
    seen = F.array_compact(F.array(*[F.when(F.count(f) > 0, F.lit(f)) for f in features]))
    action, missing = sensor_policy(F.array(*[F.lit(f) for f in features]), F.col("_seen"), most)
    found = df.groupBy(*keys).agg(seen.alias("_seen")).select(*keys, action.alias("action"), missing.alias("masked"))
    lacking = cut(found.where("action <> 'ok'"))
    rows = null_safe_join(df, lacking, keys, "left", small=lacking.count() <= BROADCAST_ROWS)
    rows = rows.withColumns({"action": F.coalesce("action", F.lit("ok")), "masked": F.coalesce("masked", F.array().cast("array<string>"))})
    return rows.where("action <> 'abort'"), rows.where("action = 'abort'")


def residuals(df: DataFrame, features: list[str], components: list[list[float]], masked: tuple[str, ...] | Column = ()) -> DataFrame:
    """Squared residual ``r_<feature>`` of the projection on the components; masked features count 0.

    ``masked`` is the same for all rows, or a column with an array of names.
    """
    hidden = masked if isinstance(masked, Column) else F.array(*[F.lit(f) for f in masked]).cast("array<string>")
    k = len(components[0])
    dot = lambda weights, cols: sum((F.lit(w) * c for w, c in zip(weights, cols)), F.lit(0.0))
    z = [F.col(f"z_{f}") for f in features]
    df = df.withColumns({f"_p{j}": dot([components[i][j] for i in range(len(features))], z) for j in range(k)})
    p = [F.col(f"_p{j}") for j in range(k)]
    out = {}
    for i, f in enumerate(features):
        gap = z[i] - dot(components[i], p)
        out[f"r_{f}"] = F.when(F.array_contains(hidden, f), 0.0).otherwise(gap * gap)
    return df.withColumns(out).drop(*[f"_p{j}" for j in range(k)])


def window_error(s: Series, features: list[str], length: int = SEQUENCE_LENGTH, out: str = "error") -> Series:
    """Mean squared residual over the last ``length`` rows and all features.

    A row's own error does not depend on its window, so the window mean is a rolling sum; a
    short history counts its first row as often as the front padding repeats it. No sequence
    of vectors is ever built.
    """
    own = sum((F.col(f"r_{f}") for f in features), F.lit(0.0)) / len(features)
    s = s.with_df(s.df.withColumn("_e", own))
    mean = lambda w: (F.sum("_e").over(w) + (length - F.count("_e").over(w)) * F.first("_e").over(w)) / length
    s = s.rolling(length - 1, 0, **{out: mean})
    return s.with_df(s.df.drop("_e"))


def window_scorer(fn: Callable) -> Callable[[Column], Column]:
    """Pluggable scorer: ``fn(batch)`` maps an array of shape (rows, length, features) to one score per row.

    Runs on Arrow batches of sequences made by `operators.windows.sequences`.
    """
    @F.pandas_udf("double")
    def score(seq: pd.Series) -> pd.Series:
        cube = np.stack([np.stack(list(rows)) for rows in seq]) if len(seq) else np.zeros((0, 1, 1))
        return pd.Series(np.asarray(fn(cube), dtype="float64"))

    return score


# -- regime density -----------------------------------------------------------------------


@dataclass
class Mixture:
    weights: list[float]
    means: list[list[float]]
    covariances: list[list[list[float]]]


# What each component adds to a row's density at least (as Spark's own mixture has it), and when a fit ends.
_LEAST, _ROUNDS, _TOLERANCE = float(np.finfo(np.float64).eps), 100, 0.01


def _whitening(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Root of the (pseudo-)inverse covariance, and the log-density at the mean."""
    values, vectors = np.linalg.eigh(cov)
    real = values > _LEAST * values.max() * len(values)
    root = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0)[:, None] * vectors.T
    return root, -0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[real]).sum())


def _blocks(df: DataFrame, features: list[str]) -> DataFrame:
    """Each batch of rows as one array, feature by feature."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).tobytes()], pa.binary())], names=["x"])

    return df.select(*[F.col(f"z_{f}").cast("double") for f in features]).mapInArrow(run, "x binary")


def _expectation(blocks: DataFrame, d: int, weights, means, covs) -> list[np.ndarray]:
    """Sums over all rows: log-likelihood; and per component the rows' shares, and these times rows and products of rows."""
    import pyarrow as pa

    shapes = [_whitening(c) for c in covs]

    def run(batches):
        total = None
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(d, -1)
                p = np.stack([_LEAST + w * np.exp(top - 0.5 * np.square(root @ (x - m[:, None])).sum(axis=0)) for w, m, (root, top) in zip(weights, means, shapes)])
                s = p.sum(axis=0)
                p /= s
                own = [np.log(s).sum(), p.sum(axis=1), p @ x.T, np.stack([(x * q) @ x.T for q in p])]
                total = own if total is None else [a + b for a, b in zip(total, own)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([np.ravel(v) for v in total]).tobytes()], pa.binary())], names=["sums"])

    k = len(weights)
    flat = sum(np.frombuffer(r["sums"]) for r in blocks.mapInArrow(run, "sums binary").collect())  # one row per partition
    return [flat[0], flat[1 : 1 + k], flat[1 + k : 1 + k + k * d].reshape(k, d), flat[1 + k + k * d :].reshape(k, d, d)]


def fit_mixture(scaled: DataFrame, features: list[str], k: int = 3, seed: int = 42) -> Mixture:
    """Full-covariance Gaussian mixture (distributed EM).

    Spark's own fit draws the start and makes the first round. It takes rows one by one, so the rounds that follow, up to a
    hundred, run over arrays of rows instead.
    """
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    names = [f"z_{f}" for f in features]
    with ExitStack() as held:
        with kept(scaled.select(*names)) as rows:
            vec = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("features")
            model = GaussianMixture(k=k, seed=seed, maxIter=1).fit(vec)
            parts = model.gaussiansDF.collect()  # k rows
            weights, before = np.array(model.weights), model.summary.logLikelihood
            means, covs = (np.array([r[c].toArray() for r in parts]) for c in ("mean", "cov"))
            blocks = held.enter_context(kept(_blocks(rows, features)))
            blocks.count()
        for _ in range(1, _ROUNDS):
            likelihood, share, first, second = _expectation(blocks, len(features), weights, means, covs)
            means = first / share[:, None]
            covs = second / share[:, None, None] - means[:, :, None] * means[:, None, :]
            weights = share / share.sum()
            if abs(likelihood - before) <= _TOLERANCE:
                break
            before = likelihood
    return Mixture(weights.tolist(), means.tolist(), covs.tolist())


def log_density(mixture: Mixture, features: list[str]) -> Column:
    """Log-density of each scaled row, log-sum-exp over the components, on Arrow batches."""
    means, covs = np.array(mixture.means), np.array(mixture.covariances)
    d = means.shape[1]
    ridge = 1e-6 * np.eye(d)
    inverse_roots = np.stack([np.linalg.inv(np.linalg.cholesky(c + ridge)) for c in covs])
    consts = np.log(mixture.weights) - 0.5 * d * np.log(2 * np.pi) + np.array([np.log(np.diag(r)).sum() for r in inverse_roots])

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy() for c in cols])
        terms = np.stack([c - 0.5 * (((x - m) @ r.T) ** 2).sum(axis=1) for c, m, r in zip(consts, means, inverse_roots)])
        top = terms.max(axis=0)
        return pd.Series(top + np.log(np.exp(terms - top).sum(axis=0)))

    return score(*[F.col(f"z_{f}") for f in features])


# -- module model -------------------------------------------------------------------------


@dataclass
class ModuleModel:
    scaler: Scaler
    components: list[list[float]]
    mixture: Mixture
    error: dict[str, float] = field(default_factory=dict)
    density: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return self.scaler.features


def raw_scores(s: Series, model: ModuleModel, masked: tuple[str, ...] | Column = ()) -> Series:
    """Imputed and scaled rows with residuals, windowed error and log-density."""
    s = W.impute(s, {f: model.scaler.mean[f] for f in model.features})
    s = s.with_df(residuals(model.scaler.apply(s.df), model.features, model.components, masked))
    s = window_error(s, model.features)
    return s.with_df(s.df.withColumn("log_density", log_density(model.mixture, model.features)))


def fit_module(s: Series, features: list[str], k: int = 2, mixture_k: int = 3, seed: int = 42) -> ModuleModel:
    """Scaler, components, mixture, then a calibration pass over the training rows."""
    scaler = fit_scaler(s.df, features)
    train = even_out(s.df.select(*scaler.features).na.fill(scaler.mean), scaler.rows)
    scaled = scaler.apply(train)
    model = ModuleModel(scaler, fit_components(scaled, scaler.features, k), fit_mixture(scaled, scaler.features, mixture_k, seed))
    return calibrate(s, model)


def calibrate(s: Series, model: ModuleModel) -> ModuleModel:
    scores = cut(raw_scores(s, model).df.select("error", "log_density"))
    model.error = exact_percentiles(scores, [], "error", ERROR_PROBS).first().asDict()
    model.density = exact_percentiles(scores, [], "log_density", DENSITY_PROBS).first().asDict()
    return model


def score_silver(s: Series, model: ModuleModel, module: str, masked: tuple[str, ...] | Column = ()) -> Series:
    """Bronze rows to silver rows: error, smoothed error, risk, severity, health, strongest residuals."""
    e, g = model.error, model.density
    s = raw_scores(s, model, masked)
    entries = F.array(*[F.struct(F.col(f"r_{f}").alias("v"), F.lit(f).alias("k")) for f in model.features])
    top = F.transform(F.slice(F.sort_array(entries, asc=False), 1, TOP_RESIDUALS), lambda x: F.struct(x["k"], x["v"]))
    keep = [*s.parts, *s.order]
    s = s.with_df(s.df.select(*keep, F.col("error").alias("raw_error"), "log_density", F.to_json(F.map_from_entries(top)).alias("top_features")))
    s = W.ema(s, F.col("raw_error"), "smoothed")
    risk = scoring.base_risk(F.col("smoothed"), *[F.lit(float(e[p])) for p in ("p95", "p99_5", "max")])
    fam = scoring.familiarity(F.col("log_density"), F.lit(float(g["p05"])), F.lit(float(g["min"])))
    s = s.with_df(s.df.withColumns({"familiarity": fam, "_risk": risk}))
    s = s.with_df(s.df.withColumn("_comp", scoring.regime_corrected(F.col("_risk"), F.col("familiarity"))))
    s = W.persistence(s, "_comp")
    comp, count = F.col("_comp"), F.col("persistence")
    df = s.df.withColumns({
        "module": F.lit(module), "composite_score": scoring.escalated_risk(comp, count),
        "severity": scoring.escalated_severity(comp, count),
    })
    df = df.withColumns({
        "health_score": scoring.health(F.col("composite_score")), "severity_code": scoring.severity_code(F.col("severity")),
    })
    return s.with_df(df.drop("_risk", "_comp", "log_density"))


# -- fault classifiers --------------------------------------------------------------------


class Untrainable(ValueError):
    """The rows of a code cannot teach a classifier."""


def fit_code(df: DataFrame, code: str, features: list[str], target: str = "target", max_iter: int = 50) -> dict:
    """Soft-label classifier on min-max scaled features.

    A row with target y is worth y of a positive and 1 - y of a negative row, which makes the
    weighted logistic loss the cross-entropy on soft targets.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    with ExitStack() as held:
        with kept(df.select(target, *features)) as raw:
            edge = raw.agg(F.count("*").alias("n"), *[F.min(f).alias(f"lo_{f}") for f in features], *[F.max(f).alias(f"hi_{f}") for f in features], F.min(target).alias("_lo"), F.max(target).alias("_hi")).first()
            if not edge["n"] or any(edge[f"lo_{f}"] is None for f in features):
                raise Untrainable(f"{code}: no rows with values in every feature")
            if edge["_lo"] is None or edge["_hi"] <= 0 or edge["_lo"] >= 1:
                raise Untrainable(f"{code}: targets of one class")
            even = held.enter_context(kept(even_out(raw, edge["n"])))
            even.count()
        lo, hi = [float(edge[f"lo_{f}"]) for f in features], [float(edge[f"hi_{f}"]) for f in features]
        unit = even.select(F.col(target).alias("_y"), *[numeric.minmax_scale(F.col(f), F.lit(a), F.lit(b)).alias(f) for f, a, b in zip(features, lo, hi)])
        both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("_y").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("_y")).alias("w"))))
        rows = unit.select(*features, both.alias("b")).select(*features, "b.label", "b.w").filter("w > 0")
        vec = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
        fit = LogisticRegression(weightCol="w", maxIter=max_iter, standardization=False).fit(vec)
    return {"code": code, "features": features, "lo": lo, "hi": hi, "coef": [float(c) for c in fit.coefficients], "intercept": float(fit.intercept)}


def fit_codes(data_for: Callable[[str, list[str]], DataFrame], catalog: list[dict]) -> tuple[list[dict], dict[str, str]]:
    """All codes of a module; one that lacks a feature, rows or one of the classes is reported and skipped.

    Any other failure is raised: a lost executor does not make a code untrainable.
    """
    models, failed = [], {}
    for entry in catalog:
        code, features = entry["dtc_code"], entry["features"]
        try:
            models.append(fit_code(data_for(code, features), code, features))
        except (AnalysisException, Untrainable) as e:
            failed[code] = str(e)
    return models, failed


def split_rows(df: DataFrame, keys: list[str], share: float = 0.8, salt: str = "split") -> tuple[DataFrame, DataFrame]:
    """Training and validation rows by key hash: no shuffle, stable under retries and reruns."""
    inside = hashing.uniform(salt, *keys) < share
    return df.filter(inside), df.filter(~inside)


# -- augmentation -------------------------------------------------------------------------

# Which physical effect a code has (fixed values); other codes gain up to 30 %.
EFFECTS = {
    "gain": ("P0217", "P0128", "P0218", "P0A1F", "C0514", "P0113", "B1081"),
    "attenuation": ("P0171", "P0524", "P0299", "P0562", "C0077", "P0868", "P0A09", "P0534"),
    "drift": ("P0420", "P0730", "P0A80", "C0078", "P0461"),
    "noise": ("P0300", "P0101", "C0031", "C0063", "C1234", "B1000"),
}


def effect_of(code: str) -> str:
    return next((name for name, codes in EFFECTS.items() if code in codes), "other")


def faulty_features(code: str, features: list[str], means: dict[str, float], severity: Column, keys: list[str]) -> dict[str, Column]:
    """Changed feature columns at a given severity."""
    first, kind = features[0], effect_of(code)
    x = F.col(first)
    if kind == "gain":
        return {first: x * (1.0 + 0.5 * severity)}
    if kind == "attenuation":
        return {first: x * (1.0 - 0.6 * severity)}
    if kind == "drift":
        return {first: x + means[first] * 0.25 * severity}
    if kind == "noise":
        return {f: F.col(f) + hashing.normal(f"{code}:{f}", *keys) * (means[f] * 0.5) * severity for f in features[:2]}
    return {first: x * (1.0 + 0.3 * severity)}


def augment(df: DataFrame, code: str, features: list[str], keys: list[str], target_rows: int | None = None) -> DataFrame:
    """Half the rows healthy (target 0), half with a fault whose severity runs evenly from 0.1 to 1.0.

    Which rows turn faulty, and in which order their severity rises, follows the key hash.
    Ranking all faulty rows is one ordered series without a key, cut into chunks like any other.
    """
    base = df.select(*keys, *features).withColumn("_h", hashing.hash_number(code, *keys))
    healthy = base.filter("_h % 2 = 0").withColumn("target", F.lit(0.0))
    sick = stored(base.filter("_h % 2 = 1"), "sick")
    stats = sick.agg(F.count("*").alias("n"), *[F.avg(f).alias(f) for f in features]).first()
    kw = {"target_rows": target_rows} if target_rows else {}
    s = Series(sick.withColumn("_all", F.lit(0)), ["_all"], ["_h", *keys], **kw).running(_i=run_count())
    severity = 0.1 + 0.9 * (F.col("_i") - 1) / F.lit(float(max(stats["n"] - 1, 1)))
    ranked = s.result().withColumn("target", severity)
    changed = faulty_features(code, features, {f: stats[f] or 0.0 for f in features}, F.col("target"), keys)
    cols = [*keys, *features, "target"]
    return healthy.select(*cols).unionByName(ranked.withColumns(changed).select(*cols))


# First and last day of the vacuum leak (fixed values).
LEAK_DAYS = (10, 38)


def vacuum_leak(df: DataFrame, day: Column, row: Column, keys: list[str], names: dict[str, str]) -> DataFrame:
    """Progressive lean running by day: ``names`` maps maf, ltft, stft, afr, rpm, load to columns."""
    start, end = LEAK_DAYS
    f = (day - (start - 1)) / F.lit(float(end - start + 1))
    active = (day >= start) & (day <= end)
    lean = F.when(f > 0.75, (f - 0.75) / 0.25).otherwise(0.0)
    miss = F.when(f > 0.85, (f - 0.85) / 0.15).otherwise(0.0)
    c = {k: F.col(v) for k, v in names.items()}
    shaken = F.sin(row * 0.8) * 120 * miss + hashing.normal("rpm", *keys) * 60 * miss
    heavy = F.when(f > 0.85, F.least(c["load"] + hashing.normal("load", *keys) * 8 * miss, F.lit(100.0))).otherwise(c["load"])
    changed = {
        "maf": c["maf"] * (1 - 0.35 * f), "ltft": c["ltft"] + 25.0 * f, "stft": c["stft"] + 8.0 * f,
        "afr": c["afr"] + 1.8 * lean, "rpm": c["rpm"] + shaken, "load": heavy,
    }
    return df.withColumns({names[k]: F.when(active, e).otherwise(c[k]) for k, e in changed.items()})

"""Row-window operators on ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorpool.operators.fold import Affine, Clamp
from motorpool.functions import scoring
from motorpool.functions.keys import null_safe_join
from motorpool.operators.series import Series, following, last_valid, next_valid, previous, run_sum


def rolling_mean_std(s: Series, column: str, n: int = 5) -> Series:
    """Mean and sample deviation of ``n`` full rows, gaps then filled backwards and forwards."""
    c = F.col(column)
    full = lambda agg: lambda w: F.when(F.count(c).over(w) == n, agg(c).over(w))
    s = s.rolling(n - 1, 0, _mean=full(F.avg), _std=full(F.stddev_samp))
    s = s.running(_mb=next_valid(F.col("_mean")), _sb=next_valid(F.col("_std")))
    s = s.running(**{f"{column}_mean": last_valid(F.col("_mb")), f"{column}_std": last_valid(F.col("_sb"))})
    return s.with_df(s.df.drop("_mean", "_std", "_mb", "_sb"))


def smooth_seams(s: Series, column: str, rows: int = 75, reach: int = 5) -> Series:
    """Centred three-row mean within ``reach`` rows of each seam (a multiple of ``rows``), others as they are.

    The mean never looks beyond its own seam's neighbourhood.
    """
    s = s.indexed("_i")
    near = F.pmod(F.col("_i") + reach, F.lit(rows)) < 2 * reach
    seam = F.when(near & (F.col("_i") + reach >= rows), F.floor((F.col("_i") + reach) / rows))
    s = s.with_df(s.df.withColumn("_seam", seam))
    pair = F.struct(F.col("_seam").alias("g"), F.col(column).alias("v"))
    s = s.running(_a=previous(pair), _b=following(pair))
    mine = lambda c: F.when(F.col(f"{c}.g") == F.col("_seam"), F.col(f"{c}.v"))
    vals = F.array_compact(F.array(mine("_a"), F.col(column), mine("_b")))
    mean = F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + v) / F.nullif(F.size(vals), F.lit(0))
    out = F.when(F.col("_seam").isNotNull(), mean).otherwise(F.col(column))
    return s.with_df(s.df.withColumn(column, out).drop("_i", "_seam", "_a", "_b"))


def interpolate(s: Series, column: str, limit: int = 2) -> Series:
    """Linear filling of the first ``limit`` NULLs of each gap; leading ones stay, trailing ones repeat the last value."""
    s = s.indexed("_i")
    point = F.when(F.col(column).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(column).alias("v")))
    s = s.running(_l=last_valid(point), _r=next_valid(point))
    gap = F.col("_i") - F.col("_l.i")
    line = F.col("_l.v") + (F.col("_r.v") - F.col("_l.v")) * gap / (F.col("_r.i") - F.col("_l.i"))
    fill = F.when(gap <= limit, F.coalesce(line, F.col("_l.v")))
    return s.with_df(s.df.withColumn(column, F.coalesce(F.col(column), fill)).drop("_i", "_l", "_r"))


def impute(s: Series, means: dict[str, float | None]) -> Series:
    """Forward fill, then the feature's mean, else 0."""
    s = s.running(**{f"_f_{c}": last_valid(F.col(c)) for c in means})
    df = s.df.withColumns({c: F.coalesce(F.col(f"_f_{c}"), F.lit(float(m or 0.0))) for c, m in means.items()})
    return s.with_df(df.drop(*[f"_f_{c}" for c in means]))


def sequences(s: Series, features: list[str], length: int = 30, pad: bool = True, out: str = "sequence") -> Series:
    """The last ``length`` feature vectors of each row; short histories repeat the first row or are left out."""
    vec = F.array(*[F.col(f).cast("double") for f in features])
    s = s.rolling(length - 1, 0, **{out: lambda w: F.collect_list(vec).over(w)})
    if not pad:
        return s.with_df(s.df.filter(F.size(out) == length))
    padded = F.concat(F.array_repeat(F.col(out)[0], length - F.size(out)), F.col(out))
    return s.with_df(s.df.withColumn(out, padded))


def ema(s: Series, x: Column, out: str = "ema", alpha: float = scoring.EMA_ALPHA, seed: float | None = 0.0) -> Series:
    """Exponential smoothing from ``seed``, or from the first value with ``seed=None``."""
    if seed is not None:
        return s.fold(out, Affine(), F.lit(float(seed)), a=F.lit(1 - alpha), b=alpha * x)
    s = s.running(_seen=previous(F.lit(True)))
    fresh = F.col("_seen").isNull()
    s = s.fold(out, Affine(), F.lit(0.0), a=F.when(fresh, 0.0).otherwise(1 - alpha), b=F.when(fresh, x).otherwise(alpha * x))
    return s.with_df(s.df.drop("_seen"))


def persistence(s: Series, risk: str, out: str = "persistence") -> Series:
    return s.fold(out, Clamp(), F.lit(0.0), **scoring.persistence_inputs(F.col(risk)))


def evidence(s: Series, p: Column, floor: float, sensitivity: float, out: str = "buildup") -> Series:
    """Running sum above a floor, capped at 1."""
    s = s.running(_sum=run_sum(F.greatest(p - floor, F.lit(0.0))))
    return s.with_df(s.df.withColumn(out, F.least(F.col("_sum") * sensitivity, F.lit(1.0))).drop("_sum"))


def decimate(s: Series, every: int = 50) -> DataFrame:
    """Rows 0, ``every``, 2 * ``every``, ... of each key."""
    s = s.indexed("_i")
    return s.result().filter(F.col("_i") % every == 0).drop("_i")


def resample(df: DataFrame, keys: list[str], t: str, values: list[str], seconds: float, target_rows: int | None = None) -> Series:
    """Means per time bin on a gap-free grid from first to last bin; empty bins are NULL.

    Each bin spreads over the empty ones behind it, so the grid needs no join.
    """
    binned = df.groupBy(*keys, F.floor(F.col(t) / seconds).alias("bin")).agg(*[F.avg(v).alias(v) for v in values])
    kw = {"target_rows": target_rows} if target_rows else {}
    s = Series(binned, keys, ["bin"], **kw).running(_next=following(F.col("bin")))
    grid = F.explode(F.sequence(F.col("bin"), F.coalesce(F.col("_next") - 1, F.col("bin"))))
    wide = s.result().withColumn("_own", F.col("bin")).withColumn("bin", grid)
    filled = wide.withColumns({v: F.when(F.col("bin") == F.col("_own"), F.col(v)) for v in values}).drop("_own", "_next")
    return Series(filled, keys, ["bin"], **kw)


def complete_blocks(s: Series, values: list[str], rows: int = 75) -> DataFrame:
    """Blocks of ``rows`` consecutive rows without NULL that end before the last ``rows``-th row."""
    s = s.indexed("_i")
    holes = F.lit(0)
    for v in values:
        holes = holes + F.col(v).isNull().cast("int")
    blocks = s.df.groupBy(*s.keys, F.floor(F.col("_i") / rows).alias("block")).agg(
        F.count("*").alias("n"), F.sum(holes).alias("holes"), *[F.avg(v).alias(f"{v}_mean") for v in values]
    )
    total = blocks.groupBy(*s.keys).agg(F.sum("n").alias("_len"))
    keep = (F.col("n") == rows) & (F.col("holes") == 0) & (F.col("block") * rows < F.col("_len") - rows)
    return null_safe_join(blocks, total, s.keys).filter(keep).drop("n", "holes", "_len")

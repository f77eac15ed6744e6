"""Operational metrics over all layers: counters, latency, lag, throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorpool.functions.numeric import round_py
from motorpool.functions.timefmt import millis_between

# Histogram bucket bounds in ms (fixed values).
LATENCY_EDGES = (5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000)


def row_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key with a grand total row (NULL keys); one partial aggregation serves both levels."""
    return df.rollup(*keys).agg(F.count("*").alias("rows"))


def counters(df: DataFrame, outcome: str, keys: list[str]) -> DataFrame:
    """Attempted, accepted and rejected; duplicates are rejections."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("attempted"), F.count_if(F.col(outcome) == "accepted").alias("accepted"),
        F.count_if(F.col(outcome) == "invalid").alias("failed_validation"),
        F.count_if(F.col(outcome).isin("invalid", "duplicate")).alias("rejected"),
    )


def histogram(df: DataFrame, keys: list[str], value: str, edges=LATENCY_EDGES) -> DataFrame:
    """Cumulative ``le`` buckets with sum and count.

    Rows are counted once in their own bucket; the few buckets per key are then summed up,
    instead of comparing every row with every edge.
    """
    v = F.col(value)
    own = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        own = F.when(v <= edges[i], F.lit(i)).otherwise(own)
    per = df.filter(v.isNotNull()).groupBy(*keys).agg(
        *[F.count_if(own == i).alias(f"_{i}") for i in range(len(edges) + 1)], F.sum(value).alias("sum"), F.count("*").alias("count")
    )
    upto, acc = [], F.lit(0).cast("long")
    for i in range(len(edges) + 1):
        acc = acc + F.col(f"_{i}")
        label = F.lit(str(edges[i]) if i < len(edges) else "+Inf")
        upto.append(F.struct(label.alias("le"), acc.alias("bucket")))
    return per.select(*keys, "sum", "count", F.explode(F.array(*upto)).alias("b")).select(*keys, "b.le", "b.bucket", "sum", "count")


def scorecard(accepted: DataFrame, rejected: DataFrame, vehicle: str, ts: str, latency: str, now: Column) -> DataFrame:
    """Per vehicle: accepted, rejected, validation rate, mean latency, seconds since last seen."""
    a = accepted.groupBy(vehicle).agg(
        F.count("*").alias("accepted"), F.avg(latency).alias("_lat"), F.max(ts).alias("_seen"), F.sum(latency).alias("latency_sum"),
        F.count(latency).alias("latency_rows"),
    )
    r = rejected.groupBy(vehicle).agg(F.count("*").alias("rejected"))
    both = a.join(r, vehicle, "full_outer")
    acc, rej = F.coalesce("accepted", F.lit(0)), F.coalesce("rejected", F.lit(0))
    rate = F.when(acc + rej > 0, acc / (acc + rej) * 100).otherwise(100.0)
    return both.select(
        vehicle, acc.alias("accepted"), rej.alias("rejected"), round_py(rate, 1).alias("validation_rate"),
        round_py(F.coalesce("_lat", F.lit(0.0)), 1).alias("avg_latency_ms"),
        round_py(millis_between(F.col("_seen"), now) / 1000.0, 1).alias("seconds_since_seen"), "latency_sum", "latency_rows",
    )


def fleet_totals(cards: DataFrame) -> DataFrame:
    """Totals over the scorecard; the mean latency is weighted by rows, the backlog is what was rejected."""
    n = F.sum("latency_rows")
    return cards.agg(
        F.sum("accepted").alias("rows"), F.count_if(F.col("accepted") > 0).alias("active_vehicles"),
        round_py(F.coalesce(F.sum("latency_sum") / F.nullif(n, F.lit(0)), F.lit(0.0)), 1).alias("avg_latency_ms"),
        F.sum("rejected").alias("dlq_backlog"),
    )


def trailing(df: DataFrame, ts: str, seconds: int = 300, anchor: Column | None = None) -> DataFrame:
    """Rows of the last ``seconds`` before the newest row ("virtual now") or before ``anchor``."""
    if anchor is not None:
        return df.filter(F.col(ts) >= anchor - F.make_dt_interval(secs=F.lit(seconds)))
    newest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.make_dt_interval(secs=F.lit(seconds)))


def module_latency(df: DataFrame, module: str, e2e: str, inference: str) -> tuple[DataFrame, DataFrame]:
    """(per module means, fleet means): the fleet figure is the unweighted mean of the module means."""
    per = df.groupBy(module).agg(F.avg(e2e).alias("avg_e2e_ms"), F.avg(inference).alias("avg_inference_ms"), F.count("*").alias("rows"))
    return per, per.agg(F.avg("avg_e2e_ms").alias("avg_e2e_ms"), F.avg("avg_inference_ms").alias("avg_inference_ms"), F.sum("rows").alias("rows"))


def layer_lags(kafka: DataFrame, bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows each layer is behind the one before, per module, and the worst lag; inputs hold (module, n)."""
    out = kafka.select("module", F.col("n").alias("kafka"))
    for name, df in (("bronze", bronze), ("silver", silver), ("gold", gold)):
        out = out.join(df.select("module", F.col("n").alias(name)), "module", "left")
    zero = F.lit(0).cast("long")
    gap = lambda a, b: F.greatest(F.coalesce(a, zero) - F.coalesce(b, zero), zero)
    lags = out.select("module", gap("kafka", "bronze").alias("bronze_lag"), gap("silver", "gold").alias("gold_lag"))
    return lags.withColumn("worst", F.greatest("bronze_lag", "gold_lag"))


def rows_after(df: DataFrame, ts: str, mark) -> DataFrame:
    return df.agg(F.count_if(F.col(ts) > F.lit(mark)).alias("lag"))


def writer_summary(writers: DataFrame, running_only: bool = False) -> DataFrame:
    """Active writers, rows, lag and mean duration of ``(module, status, total_rows, lag, duration_ms)``."""
    timed = F.when(F.col("status") == "RUNNING", F.col("duration_ms")) if running_only else F.col("duration_ms")
    return writers.agg(
        F.count_if(F.col("status") == "RUNNING").alias("active"), F.sum("total_rows").alias("total_rows"),
        F.sum("lag").alias("total_lag"), F.avg(timed).alias("avg_duration_ms"),
    )


def throughput(before: DataFrame, after: DataFrame, seconds: float) -> DataFrame:
    """Rates between two snapshots ``(module, incoming, written)`` with a SUMMARY row."""
    b = before.select("module", F.col("incoming").alias("i0"), F.col("written").alias("w0"))
    j = after.join(b, "module", "left")
    zero = F.lit(0)
    per = j.select(
        "module", (F.col("incoming") - F.coalesce("i0", zero)).alias("d_in"), (F.col("written") - F.coalesce("w0", zero)).alias("d_out"),
        (F.col("incoming") - F.col("written")).alias("backlog"),
    )
    label = F.when(F.grouping("module") == 1, F.lit("SUMMARY")).otherwise(F.col("module"))
    return per.rollup("module").agg(
        label.alias("name"), (F.sum("d_in") / F.lit(seconds)).alias("in_rate"), (F.sum("d_out") / F.lit(seconds)).alias("write_rate"),
        F.sum("backlog").alias("backlog"),
    ).drop("module")


def module_status(kafka: DataFrame, bronze: DataFrame, listener: DataFrame) -> DataFrame:
    """Every broker module with its bronze rows and writer state; 0 and OFFLINE where unknown."""
    return (
        kafka.join(bronze, "module", "left").join(listener, "module", "left")
        .select(
            "module", "offered", F.coalesce("written", F.lit(0)).alias("written"), F.coalesce("status", F.lit("OFFLINE")).alias("status"),
            (F.col("offered") - F.coalesce("written", F.lit(0))).alias("lag"),
        )
    )


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Newest ``n`` rows (an ordered top-n, no full sort)."""
    return df.orderBy(*[F.desc(o) for o in order]).limit(n)


def history(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    return tail(df, order, n).orderBy(*order)


def last_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Newest ``n`` rows per key; the rank limit also runs before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """Fair cap of a batch: oldest ``n`` rows per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key as an aggregate, so a dominant key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*keys, "r.*")


def value_counts(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width counts with the last bin closed on the right."""
    b = F.least(F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return df.groupBy(b.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def exposition(lines: DataFrame, line: str = "value") -> DataFrame:
    """Metric text lines ``name{vehicle="..",module=".."} value`` as rows; comments are skipped."""
    pick = lambda g: F.regexp_extract(line, r'^(\w+)\{vehicle="([^"]*)",module="([^"]*)"\}\s+([0-9.eE+-]+)$', g)
    return lines.select(
        pick(1).alias("metric"), pick(2).alias("vehicle"), pick(3).alias("module"), pick(4).try_cast("double").alias("reading")
    ).filter("metric <> ''")


def dataset_metadata(df: DataFrame, trip: str) -> DataFrame:
    """Rows, highest trip number, and type and nullability per column."""
    cols = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.count_if(F.col(f.name).isNull()).alias("nulls"))
                     for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType))])
    one = df.agg(F.count("*").alias("rows"), F.max(trip).alias("max_trip"), cols.alias("c"))
    return one.select("rows", "max_trip", F.explode("c").alias("c")).select("rows", "max_trip", "c.*")


def sketches(df: DataFrame, keys: list[str], distinct: str, value: str) -> DataFrame:
    """Stored summaries per group: rows, a sketch of the distinct values of one column (HLL) and one of the distribution
    of another (KLL). They merge, so a roll-up reads summaries and never the rows again."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.hll_sketch_agg(distinct, F.lit(14)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), 800).alias("value_sketch"),
    )


def rolled_up(stored: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Rows, distinct values (about 1 % error) and quantiles (rank error about 0.5 %) from stored sketches."""
    merged = stored.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("distinct_sketch").alias("_d"), F.kll_merge_agg_double("value_sketch").alias("_v"),
    )
    quantiles = [F.kll_sketch_get_quantile_double("_v", F.lit(p)).alias(n) for n, p in probs.items()]
    return merged.select(*keys, "rows", F.hll_sketch_estimate("_d").alias("distinct_values"), *quantiles)

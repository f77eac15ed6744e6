"""Micro-batch sinks that rewrite what a batch touches, and nothing twice when a batch is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.functions.timefmt import floor_seconds
from motorpool.plans.health import WINDOW_SECONDS, Fusion, gold_health
from motorpool.sources.streams import source_bucket
from motorpool.sources.tables import RUN, run_number

BUCKETS = 64


def _write_parts(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for: a replayed batch replaces its own."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def restating_sink(
    df: DataFrame, bronze: str, gold: str, checkpoint: str, fusion: Fusion | None = None, seconds: int = WINDOW_SECONDS,
    buckets: int = BUCKETS, trigger: dict | None = None,
):
    """Keep rows and the gold windows that follow from them, also for rows that come late.

    Input ``source_id, module, ts, event_id, health, features``. A micro-batch is appended to ``bronze``, partitioned by
    source bucket; then, for the vehicles it touched, all windows from the first touched one on are computed again and
    written to ``gold`` under the batch's version. Only the touched buckets are read again. Readers take `current_gold`.
    """
    fusion = fusion or Fusion()
    spark, schema = df.sparkSession, df.schema
    run = run_number(spark, checkpoint, gold)

    def write(batch: DataFrame, batch_id: int):
        version = run * RUN + batch_id
        rows = batch.withColumns({"source_bucket": source_bucket("source_id", buckets), "version": F.lit(version)})
        _write_parts(rows, bronze, ["source_bucket", "version"])
        stored = spark.read.schema(rows.schema).parquet(bronze).filter(F.col("version") <= version)
        own = stored.filter(F.col("version") == version)
        since = own.groupBy("source_bucket", "source_id").agg(F.min(floor_seconds(F.col("ts"), seconds)).alias("_since"))
        # at most ``buckets`` numbers; as literals they prune folders
        touched = [r.source_bucket for r in own.select("source_bucket").distinct().collect()]
        if not touched:
            return
        history = stored.filter(F.col("source_bucket").isin(touched)).join(since.select("source_id"), "source_id", "left_semi")
        again = gold_health(history.select(*schema.names), fusion, seconds)
        again = again.join(since.select("source_id", "_since"), "source_id").filter(F.col("gold_window_ts") >= F.col("_since")).drop("_since")
        _write_parts(again.withColumns({"source_bucket": source_bucket("source_id", buckets), "version": F.lit(version)}), gold, ["source_bucket", "version"])

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current_gold(spark: SparkSession, gold: str) -> DataFrame:
    """The last written row of each vehicle and window."""
    rows = spark.read.parquet(gold)
    kept = [c for c in rows.columns if c not in ("source_id", "gold_window_ts")]
    best = rows.groupBy("source_id", "gold_window_ts").agg(F.max_by(F.struct(*kept), "version").alias("r"))
    return best.select("source_id", "gold_window_ts", "r.*").drop("source_bucket", "version")


def split_sink(
    df: DataFrame, check: Callable[[DataFrame], DataFrame], good: str, dead: str, checkpoint: str, letters: Callable[[DataFrame], DataFrame],
    day: Column, trigger: dict | None = None,
):
    """Valid rows to ``good`` (Parquet) and rejects to ``dead`` (JSON lines by day) from one parse per micro-batch.

    ``check`` adds ``error``, NULL for valid rows; ``letters`` shapes the rejects and keeps their ``day``. Both outputs
    lie under ``version``, the number of run and batch, so a replayed batch replaces its own rows. Rejects without a
    day go to the default partition.
    """
    spark = df.sparkSession
    run = run_number(spark, checkpoint, good)

    def write(batch: DataFrame, batch_id: int):
        version = run * RUN + batch_id
        checked = check(batch).persist(StorageLevel.DISK_ONLY)
        try:
            bad = checked.filter(F.col("error").isNotNull()).withColumn("day", day)
            filed = letters(bad).withColumn("version", F.lit(version))
            filed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "day").json(dead)
            checked.filter(F.col("error").isNull()).drop("error").write.mode("overwrite").parquet(f"{good}/v{version}")
        finally:
            checked.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

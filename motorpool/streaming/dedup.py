"""Streaming de-duplication and tolerant parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.sources.tables import RUN, latest_per_key, run_number, unseen, versions


def dedup(df: DataFrame, key: str = "row_hash", ts: str = "ingest_ts", within: str | None = "1 hour") -> DataFrame:
    """First row per key. State is dropped ``within`` after the watermark passes the row, and rows later than
    that are dropped with it; `dedup_sink` keeps them. ``within=None`` keeps every key for ever."""
    if within is None:
        return df.dropDuplicates([key])
    return df.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def dedup_sink(df: DataFrame, path: str, checkpoint: str, key: str = "row_hash", ts: str = "ingest_ts", trigger: dict | None = None, buckets: int = 64):
    """Append the first row of every key, however late it comes.

    Each micro-batch keeps its earliest row per key and joins the keys written before; it is written under the number
    of run and batch, so a replay rewrites itself. Nothing is forgotten, as no watermark is involved. The keys alone
    are written again below ``keys``, a folder for each of ``buckets`` hash buckets: a micro-batch opens those of its
    own buckets only. Versions without such folders are read by their key column. ``buckets`` stays the same for a path.
    """
    spark, schema = df.sparkSession, df.schema
    run = run_number(spark, checkpoint, path)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")

    def write(batch: DataFrame, batch_id: int):
        version = run * RUN + batch_id
        first = latest_per_key(batch, [key], [F.col(ts).asc()])
        known = [v for v in versions(spark, path) if v < version]
        if known:
            placed = set(versions(spark, f"{path}/keys")).intersection(known)
            touched = {r[0] for r in batch.select(bucket).distinct().collect()}  # at most ``buckets`` numbers
            seen = [f for v, n, f in _folders(spark, f"{path}/keys") if v in placed and n in touched]
            seen += [f"{path}/v{v}" for v in known if v not in placed]
            if seen:
                first = unseen(first, spark.read.schema(schema).parquet(*seen), [key])
        first.write.mode("overwrite").parquet(f"{path}/v{version}")
        keys = spark.read.schema(schema).parquet(f"{path}/v{version}").select(key, bucket)
        keys.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/keys/v{version}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _folders(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(version, bucket, folder) below ``path``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root.suffix("/v*/bucket=*")) or []
    at = [f.getPath() for f in found]
    return [(int(p.getParent().getName()[1:]), int(p.getName()[7:]), p.toString()) for p in at]


def outcomes(df: DataFrame, key: str, ts: str, order: str, ttl_seconds: int = 3600, buckets: int = 1024) -> DataFrame:
    """Every row with ``accepted`` true or false; a key is fresh again ``ttl_seconds`` after it was accepted.

    Exact expiry inside a micro-batch needs Python; it is called once per hash bucket of keys, whose state holds the
    bucket's keys with the time each was accepted. Expired ones go when the watermark has passed them. ``buckets`` stays
    the same for a checkpoint. `dedup` with ``within`` set to the TTL stays in the JVM and is the choice where only the
    accepted rows are wanted.

    Keys are row hashes, so one key is only ever as large as its own repeats. A row without a time is accepted if its
    key is not known, and leaves no time.
    """
    import pandas as pd

    ttl = ttl_seconds * 1_000_000

    def judge(_bucket, batches, state):
        since = dict(zip(*state.get, strict=True)) if state.exists else {}
        if not state.hasTimedOut:
            for_key, parts = since.get, list(batches)
            rows = (parts[0] if len(parts) == 1 else pd.concat(parts)).sort_values(["_at", order])
            flags = []
            for k, at, timed in zip(rows[key].tolist(), rows["_at"].tolist(), rows["_at"].notna().tolist()):
                last = for_key(k)
                fresh = last is None or (timed and at - last > ttl)
                if fresh and timed:
                    since[k] = int(at)
                flags.append(fresh)
            yield pd.DataFrame({key: rows[key], order: rows[order], "accepted": flags})
        mark = state.getCurrentWatermarkMs()
        since = {k: at for k, at in since.items() if at + ttl > mark * 1000}
        if since:
            state.update((list(since), list(since.values())))
            state.setTimeoutTimestamp(-(-(min(since.values()) + ttl) // 1000))
        elif state.exists:
            state.remove()

    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, order)}
    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")
    slim = df.select(key, ts, order, F.unix_micros(ts).alias("_at"), bucket.alias("_bucket")).withWatermark(ts, f"{ttl_seconds} seconds")
    return slim.groupBy("_bucket").applyInPandasWithState(
        judge, f"{key} {kinds[key]}, {order} {kinds[order]}, accepted boolean", f"keys array<{kinds[key]}>, since array<bigint>", "append", "EventTimeTimeout"
    )


def tolerant(df: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, unreadable texts): bad JSON is never fatal and never silently a row of NULLs."""
    parsed = df.withColumn("_p", F.from_json(value, f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
    return parsed.filter(~bad).withColumn("_p", F.col("_p").dropFields("_corrupt")), parsed.filter(bad).drop("_p")

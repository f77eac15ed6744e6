"""Stream sources and sinks; Kafka where its connector is on the class path, files otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source(spark: SparkSession, module: str, servers: str, max_per_trigger: int = 10_000) -> DataFrame:
    """``telemetry.<module>`` from the earliest offset, as text values with the broker time."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", f"telemetry.{module}")
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .option("failOnDataLoss", "false")
        .load()
    )
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset", "timestamp")


def file_source(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def to_broker_rows(df: DataFrame, topics: dict[str, str], value: Column, module: str = "module", key: str = "vehicle_id"):
    """(rows ready for a Kafka sink, rows of modules without a topic)."""
    topic = F.try_element_at(F.create_map(*[F.lit(v) for kv in topics.items() for v in kv]), F.col(module))
    tagged = df.withColumn("_topic", topic)
    good = tagged.filter(F.col("_topic").isNotNull()).select(F.col(key).alias("key"), value.alias("value"), F.col("_topic").alias("topic"))
    return good, tagged.filter(F.col("_topic").isNull()).drop("_topic")


def kafka_sink(rows: DataFrame, servers: str, checkpoint: str, name: str, trigger: dict | None = None):
    """Write the rows of `to_broker_rows` to the topics they name. Every replica acknowledges a row, and the producer is
    idempotent, so a retried batch adds none twice within a producer's life."""
    return (
        rows.select("key", "value", "topic").writeStream.format("kafka").queryName(name)
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
    )


def by_source(df: DataFrame, source: str, row_key: str, buckets: int = 64, writers: int = 4) -> DataFrame:
    """Add ``source_bucket`` and spread rows for writing: all rows of a bucket go to a few tasks, so a
    micro-batch writes ``buckets * writers`` files at most, and a dominant source is still shared by ``writers`` tasks."""
    tagged = df.withColumn("source_bucket", source_bucket(source, buckets))
    return tagged.repartition("source_bucket", F.pmod(F.xxhash64(row_key), F.lit(writers)))


def source_bucket(source: str | Column, buckets: int = 64) -> Column:
    """Bucket of a source; filter on it as well as on the source to prune folders."""
    return F.pmod(F.xxhash64(source), F.lit(buckets)).cast("int")


def append_sink(df: DataFrame, path: str, checkpoint: str, name: str, partition_by: tuple[str, ...] = (),
                fmt: str = "parquet", trigger: dict | None = None):
    """Append sink with a checkpoint; 1 s micro-batches unless told otherwise."""
    return (
        df.writeStream.format(fmt).queryName(name).outputMode("append").partitionBy(*partition_by)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"})).start()
    )


def drain(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), mode: str = "append") -> DataFrame:
    """Run a stream over all data now available into files and read the result back."""
    from motorpool.session import scratch_path

    spark = df.sparkSession
    base = scratch_path(spark, label)
    query = append_sink(df, f"{base}/data", f"{base}/state", f"{label}-{base[-8:]}", partition_by, trigger={"availableNow": True})
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/data")

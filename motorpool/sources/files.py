"""File sources and sinks: CSV rows, discovery, dead letters, commit logs, state files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorpool.operators.series import Series, small_side


def read_rows(spark: SparkSession, path: str, columns: list[str], start_after: int = -1) -> DataFrame:
    """CSV rows as text with their 0-based ``row_index`` inside each file, from ``start_after`` + 1 on.

    A file larger than one split is read by many tasks: rows are ordered by split offset and
    position in the split, and positions add up across splits.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    tagged = raw.select(
        "*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    rows = Series(tagged, ["source_file"], ["_block", "_at"]).indexed("row_index").result()
    return rows.filter(F.col("row_index") > start_after).drop("_block", "_at")


def resume_rows(rows: DataFrame, checkpoints: DataFrame, key: str = "source_file") -> DataFrame:
    """Rows after the last delivered index of each source; sources without one start at 0."""
    done = checkpoints.select(key, "last_row_index")
    joined = rows.join(done, key, "left")
    return joined.filter(F.col("row_index") > F.coalesce("last_row_index", F.lit(-1))).drop("last_row_index")


def discover_sources(listing: DataFrame, patterns: dict[str, str], enabled: Iterable[str] | None = None) -> DataFrame:
    """One row per expected (vehicle, module): its path when exactly one file matches, else an error.

    ``patterns`` maps a module to a regular expression on the file name. Enabled vehicles
    that have no folder are reported once, with a NULL module.
    """
    spark = listing.sparkSession
    found = listing.select(
        "path", F.regexp_extract("path", r"/(sim\d+)/[^/]+$", 1).alias("vehicle"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
    ).filter("vehicle <> ''")
    modules = spark.createDataFrame(list(patterns.items()), "module string, pattern string")
    vehicles = found.select("vehicle").distinct()
    unknown = None
    if enabled is not None:
        wanted = spark.createDataFrame([(v,) for v in enabled], "vehicle string")
        unknown = wanted.join(vehicles, "vehicle", "left_anti")
        vehicles = wanted.join(vehicles, "vehicle", "left_semi")
    # The module list comes from the contract: a handful of rows.
    expected = vehicles.select("vehicle", F.explode(F.array(*[F.lit(m) for m in patterns])).alias("module"))
    matched = found.join(F.broadcast(modules), F.regexp_like("file", F.col("pattern"))).groupBy("vehicle", "module").agg(
        F.count("*").alias("n"), F.min("path").alias("path")
    )
    out = expected.join(matched, ["vehicle", "module"], "left").select(
        "vehicle", "module", F.coalesce("n", F.lit(0)).cast("long").alias("files"),
        F.when(F.col("n") == 1, F.col("path")).alias("path"),
        F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").alias("error"),
    )
    if unknown is not None:
        out = out.unionByName(
            unknown.select("vehicle", F.lit(None).cast("string").alias("module"), F.lit(0).cast("long").alias("files"),
                           F.lit(None).cast("string").alias("path"), F.lit("unknown vehicle").alias("error"))
        )
    return out


def newer_than(df: DataFrame, column: str, last, limit: int | None = None, ties: tuple[str, ...] = (), last_ties: tuple = ()) -> DataFrame:
    """Incremental read; the comparison with a literal reaches the Parquet scan.

    ``last_ties`` are the values of ``ties`` in the last row read so far. With them the mark is the whole order, so
    rows of the same time after that row are still to come; without them all rows of that time count as read.
    """
    mark = F.lit(last)
    fresh = F.col(column) > mark
    if last_ties:
        seen = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(ties, last_ties, strict=True)])
        df = df.filter(F.col(column) >= mark)
        fresh = fresh | ((F.col(column) == mark) & (F.struct(*ties) > seen))
    rows = df.filter(fresh)
    return rows if limit is None else rows.orderBy(column, *ties).limit(limit)


def read_capped(df: DataFrame, column: str, ties: tuple[str, ...], last, limit: int, path: str) -> DataFrame:
    """All rows after the mark as capped reads, oldest first: folder ``part=i`` below ``path`` holds the i-th ``limit`` rows.

    The rows are numbered once in the order of ``column`` and ``ties``, which must be unique; no read scans the table
    again. Rows without a time have no place in that order: they are kept in ``part=-1``.
    """
    later = df.filter(F.col(column) > F.lit(last)).withColumn("_all", F.lit(0))
    numbered = Series(later, ["_all"], [column, *ties]).indexed("_pos").result()
    parts = numbered.withColumn("part", F.floor(F.col("_pos") / limit).cast("int")).drop("_all", "_pos")
    untimed = df.filter(F.col(column).isNull()).withColumn("part", F.lit(-1))
    share = F.when(F.col("part") < 0, F.pmod(F.xxhash64(*ties), F.lit(64))).otherwise(0)
    parts.unionByName(untimed).repartition("part", share).write.mode("overwrite").partitionBy("part").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def newer_per_key(df: DataFrame, marks: DataFrame, keys: list[str], column: str, tie: str, cap: int | None = None) -> DataFrame:
    """Rows after each key's own (time, tie) mark, at most ``cap`` oldest ones per key and call.

    The rest of a key is not lost: it is read by later calls, whose marks have moved.
    """
    m = small_side(marks.select(*keys, F.col(column).alias("_t"), F.col(tie).alias("_h")), marks.count())
    fresh = df.join(m, keys, "left").filter(
        F.col("_t").isNull() | (F.col(column) > F.col("_t")) | ((F.col(column) == F.col("_t")) & (F.col(tie) > F.col("_h")))
    ).drop("_t", "_h")
    if cap is None:
        return fresh
    w = Window.partitionBy(*keys).orderBy(column, tie)
    return fresh.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap).drop("_r")


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All appended versions of a table; columns added later are NULL in older files."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def union_merged(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def drop_present(df: DataFrame, deny: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in deny if c in df.columns])


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").option("header", True).options(**options).csv(path)


def dead_letters(df: DataFrame, error_type: Column, message: Column, details: Column, raw: Column, now: Column) -> DataFrame:
    """Reject rows in the dead-letter layout, with the ``day`` they are filed under."""
    return df.withColumns({
        "error_type": error_type, "error_message": message, "error_details": details, "raw_row": raw,
        "ingest_ts": now, "day": F.date_format(now, "yyyy-MM-dd"),
    })


def write_dead_letters(df: DataFrame, path: str, by: tuple[str, ...] = ("day",)) -> None:
    """JSON lines by day; add ``source_id`` to ``by`` only while sources are few.

    The rebalance hint gathers a day's rows into few files and still splits a huge day.
    """
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).json(path)


_LOG = "struct<add:struct<path:string,stats:string>,remove:struct<path:string>>"


def commit_log_counts(lines: DataFrame, keys: list[str], subtract_removed: bool = False, line: str = "value") -> DataFrame:
    """Rows per table from the ``add`` statistics of JSON commit lines.

    Removed files are ignored unless asked for; then a file counts only while its last action is an add.
    """
    entry = F.from_json(line, _LOG)
    rows = F.get_json_object("_e.add.stats", "$.numRecords").cast("long")
    acts = lines.select(*keys, entry.alias("_e")).select(
        *keys, rows.alias("n"), F.coalesce("_e.add.path", "_e.remove.path").alias("path"),
        F.col("_e.remove").isNotNull().alias("gone"),
    )
    if subtract_removed:
        kept = acts.groupBy(*keys, "path").agg(F.sum("n").alias("n"), F.bool_or("gone").alias("gone")).filter("NOT gone")
        return kept.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return acts.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


_STREAM = (
    "struct<status:string,num_input_rows:bigint,total_rows:bigint,backlog:bigint,"
    "input_rate:double,process_rate:double,duration_ms:bigint,last_updated:string>"
)


def explode_metrics(lines: DataFrame, line: str = "value") -> DataFrame:
    """Nested writer state ``{"streams": {name: {...}}}`` as one row per stream."""
    parsed = lines.select(F.from_json(line, f"struct<streams:map<string,{_STREAM}>>").alias("m"))
    return parsed.select(F.explode("m.streams").alias("stream", "s")).select("stream", "s.*")


def set_modified(spark: SparkSession, glob: str, at_ms: int) -> None:
    """Stamp files with a modification time, as a copy that keeps times would."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(glob)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.globStatus(pattern) or []:
        fs.setTimes(f.getPath(), at_ms, -1)


def recent_files(df: DataFrame, newest: int) -> DataFrame:
    """Rows of the ``newest`` most recently modified files (name breaks ties)."""
    meta = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_modification_time").alias("_m"))
    top = meta.select("_f", "_m").distinct().orderBy(F.desc("_m"), F.desc("_f")).limit(newest).select("_f")
    return meta.join(F.broadcast(top), "_f", "left_semi").drop("_f", "_m")

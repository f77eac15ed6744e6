"""Keyed table upsert on plain files, or MERGE where the table format has it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorpool.functions.keys import null_safe_join


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Last row per key; the rank limit is applied before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() if isinstance(o, str) else o for o in order])
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def unseen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key was not seen before; repeats of a seen key are combined before the shuffle. NULL is a key."""
    return null_safe_join(df, seen.select(*keys).distinct(), keys, "left_anti").select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Update-all / insert-all: updates win, untouched rows stay. ``updates`` has unique keys; NULL is one of them."""
    kept = null_safe_join(target, updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def upsert_split(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Every key with what an upsert does to it: updated, inserted or untouched."""
    t = target.select(*keys, F.lit(True).alias("_t"))
    u = updates.select(*keys, F.lit(True).alias("_u"))
    action = F.when(F.col("_t").isNull(), "inserted").when(F.col("_u").isNull(), "untouched").otherwise("updated")
    return t.join(u, keys, "full_outer").select(*keys, action.alias("action"))


#: Versions of one streaming run: batch ids start at 0 again after a checkpoint reset, run numbers do not.
RUN = 1_000_000_000
_BUCKET = "key_bucket"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions ``v<number>`` below a folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    done = fs.globStatus(root.suffix("/v*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName()[1:]) for f in done)


def run_number(spark: SparkSession, checkpoint: str, path: str) -> int:
    """Number of the run that owns a checkpoint, noted in its folder; a fresh checkpoint comes after all versions."""
    root = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    noted = fs.globStatus(root.suffix("/run-*")) or []
    if noted:
        return max(int(f.getPath().getName()[4:]) for f in noted)
    known = versions(spark, path)
    number = known[-1] // RUN + 1 if known else 0
    fs.mkdirs(root)
    fs.create(root.suffix(f"/run-{number}")).close()
    return number


class UpsertTable:
    """Versioned Parquet folder in hash buckets of the keys: an upsert rewrites the buckets of its own keys only.

    Version n holds the buckets that its upsert touched; the table at n is the newest folder of each bucket among the
    versions up to n. Only versions whose job committed count, so a job that dies half way changes nothing, and a
    micro-batch that is replayed rewrites only its own version. The ``keep`` newest versions stay for readers that are
    still at one; bucket folders that none of these shows any more are removed. An upsert that adds a column, or widens
    one, and the first one after versions without buckets rewrite all. ``buckets`` stays the same for a path.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], keep: int = 5, buckets: int = 16):
        self.spark, self.path, self.keys, self.keep, self.buckets = spark, path.rstrip("/"), keys, keep, buckets

    def versions(self) -> list[int]:
        return versions(self.spark, self.path)[-self.keep :]

    def folders(self, upto: int) -> dict[int, list[tuple[int, str]]]:
        """Per bucket the (version, folder) that hold it among the committed versions up to a number, oldest first."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(root.suffix(f"/v*/{_BUCKET}=*")) or []
        done, out = set(versions(self.spark, self.path)), {}
        for path in (f.getPath() for f in found):
            number = int(path.getParent().getName()[1:])
            if number in done and number <= upto:
                out.setdefault(int(path.getName().split("=")[1]), []).append((number, path.toString()))
        return {b: sorted(held) for b, held in out.items()}

    def read(self, before: int | None = None) -> DataFrame | None:
        known = [v for v in versions(self.spark, self.path) if before is None or v < before]
        if not known:
            return None
        held = self.folders(known[-1])
        return self.spark.read.parquet(*([h[-1][1] for h in held.values()] or [f"{self.path}/v{known[-1]}"]))

    def upsert(self, updates: DataFrame, version: int | None = None) -> None:
        if version is None:
            version = max(self.versions(), default=-1) + 1
        current, held = self.read(before=version), self.folders(version - 1)
        merged = updates if current is None else upsert(current, updates, self.keys)
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast(merged.schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")
        if held and [(f.name, f.dataType) for f in merged.schema] == [(f.name, f.dataType) for f in current.schema]:
            touched = {r[0] for r in updates.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets`` numbers
            old = [h[-1][1] for b, h in held.items() if b in touched]
            merged = upsert(self.spark.read.schema(current.schema).parquet(*old), updates, self.keys) if old else updates.select(*current.columns)
            merged = merged.select(*[F.col(f.name).cast(f.dataType) for f in current.schema])
        placed = merged.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET)
        placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/v{version}")
        if not self.folders(version):
            merged.limit(0).write.mode("overwrite").parquet(f"{self.path}/v{version}")  # an empty table has a schema too
        self._remove_old(version)

    def _remove_old(self, version: int) -> None:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        known = [v for v in versions(self.spark, self.path) if v <= version]
        oldest = known[-self.keep :][0]
        live = set()
        for held in self.folders(version).values():
            shown = max((v for v, _ in held if v <= oldest), default=oldest)
            for v, folder in held:
                if v < shown:
                    fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder), True)
                else:
                    live.add(v)
        for v in [v for v in known if v < oldest and v not in live]:
            fs.delete(root.suffix(f"/v{v}"), True)


class MergeTable:
    """The same for a catalog table whose format supports row-level updates."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, name, keys

    def upsert(self, updates: DataFrame, version: int | None = None) -> None:
        merge_into(self.spark, self.path, updates, self.keys)


def merge_into(spark: SparkSession, table: str, updates: DataFrame, keys: list[str]) -> None:
    """MERGE for catalogs whose table format supports row-level updates."""
    view = f"_updates_{uuid.uuid4().hex}"
    updates.createOrReplaceTempView(view)
    on = " AND ".join(f"t.{k} <=> u.{k}" for k in keys)
    session = updates.sparkSession
    session.sql(
        f"MERGE INTO {table} t USING {view} u ON {on} WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    session.catalog.dropTempView(view)

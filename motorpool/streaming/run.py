"""Running queries: one per module, progress metrics, upsert sinks, checkpoints."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from motorpool.sources.streams import file_source
from motorpool.sources.tables import RUN, MergeTable, UpsertTable, latest_per_key, run_number


class ProgressMetrics(StreamingQueryListener):
    """Collects one row of metrics per query and progress event; ``totals`` counts over the query's life."""

    def __init__(self):
        self.streams: dict[str, dict] = {}
        self._names: dict[str, str] = {}

    def onQueryStarted(self, event):
        self._names[str(event.id)] = event.name or str(event.id)
        self._entry(event.id)["status"] = "RUNNING"

    def onQueryProgress(self, event):
        p = event.progress
        e = self._entry(p.id, p.name)
        e["status"] = "RUNNING"
        e["num_input_rows"] = p.numInputRows
        e["total_rows"] = e.get("total_rows", 0) + p.numInputRows
        e["input_rate"], e["process_rate"] = p.inputRowsPerSecond, p.processedRowsPerSecond
        e["duration_ms"] = p.batchDuration
        e["backlog"] = sum(self._behind(s) for s in p.sources)
        for row in (p.observedMetrics or {}).values():
            kept = e.setdefault("observed", {})
            for metric, value in row.asDict().items():
                kept[metric] = kept.get(metric, 0) + (value or 0)
        e["last_updated"] = datetime.now(timezone.utc).isoformat()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._entry(event.id)["status"] = "FAILED" if event.exception else "STOPPED"

    @staticmethod
    def _behind(source) -> int:
        m = source.metrics or {}
        return int(float(m.get("maxOffsetsBehindLatest", m.get("avgOffsetsBehindLatest", 0))))

    def _entry(self, query_id, name=None):
        key = name or self._names.get(str(query_id), str(query_id))
        return self.streams.setdefault(key, {})

    def document(self) -> str:
        return json.dumps({"streams": self.streams})


def counted(df: DataFrame, name: str, outcome: str, module: str, modules: list[str]) -> DataFrame:
    """The stream with the counters of `observe.counters` per module attached to its progress events.

    They are computed while the rows pass, so they cost no second pass; `ProgressMetrics` adds them up under "observed",
    as ``<module>.<counter>``.
    """
    o, aggregates = F.col(outcome), []
    for m in modules:
        here = F.col(module) == m
        wanted = {"attempted": here, "accepted": here & (o == "accepted"), "failed_validation": here & (o == "invalid"), "rejected": here & o.isin("invalid", "duplicate")}
        aggregates += [F.count_if(cond).alias(f"{m}.{counter}") for counter, cond in wanted.items()]
    return df.observe(name, *aggregates)


def in_steps(spark: SparkSession, parts: list[DataFrame], folder: str, start: Callable[[DataFrame], object]) -> list[object]:
    """Let ``parts`` arrive one after the other in a folder: each is written in as many files as it has partitions and
    drained by a query that ``start`` resumes from its checkpoint, so all rows of a part share one micro-batch."""
    queries = []
    for part in parts:
        part.write.mode("append").parquet(folder)
        queries.append(start(file_source(spark, folder, part.schema)))
        queries[-1].awaitTermination()
    return queries


def per_module(modules: list[str], start: Callable[[str], object]) -> tuple[dict[str, object], dict[str, Exception]]:
    """One isolated query per module: (running queries, failures); a failing start of one does not stop the others."""
    running, failed = {}, {}
    for m in modules:
        try:
            running[m] = start(m)
        except Exception as e:  # noqa: BLE001
            failed[m] = e
    return running, failed


def in_pool(spark: SparkSession, pool: str) -> None:
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)


def upsert_sink(df: DataFrame, table: UpsertTable | MergeTable, checkpoint: str, order: str = "seq", trigger: dict | None = None, mode: str = "append"):
    """Collapse each micro-batch to the last payload per key, then upsert; a replayed batch rewrites its own version.

    A version is the number of the run and the batch, so a run after a checkpoint reset goes on above the old ones.
    """
    run = run_number(df.sparkSession, checkpoint, table.path) if isinstance(table, UpsertTable) else 0

    def write(batch: DataFrame, batch_id: int):
        table.upsert(latest_per_key(batch, table.keys, [order]), version=run * RUN + batch_id)

    return df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def snapshot_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Complete-mode aggregates as versions of run and batch; readers take the newest."""
    run = run_number(df.sparkSession, checkpoint, path)

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{path}/v{run * RUN + batch_id}")

    return (
        df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def archive_checkpoint(spark: SparkSession, path: str) -> str | None:
    """Reset: the old checkpoint is set aside, not deleted, and the next start reads from the beginning."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return None
    kept = f"{path.rstrip('/')}.{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    fs.rename(fs_path, spark._jvm.org.apache.hadoop.fs.Path(kept))
    return kept


def observer_snapshot(df: DataFrame, vehicle: str, module: str, ts: str, latency: str) -> DataFrame:
    """Running per-vehicle picture for complete or update mode."""
    return df.groupBy(vehicle).agg(
        F.count("*").alias("rows"), F.sum(latency).alias("latency_sum"), F.max(ts).alias("last_seen"),
        F.max_by(module, F.struct(ts, "event_id")).alias("last_module"),
    )

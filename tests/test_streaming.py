"""Streams cut into several micro-batches must give what the batch forms give."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import fault_rows, machine

from motorpool.operators import windows as W
from motorpool.operators.series import Series
from motorpool.plans import health as H
from motorpool.sources.streams import drain, file_source
from motorpool.sources.tables import UpsertTable
from motorpool.streaming import dedup as DD
from motorpool.streaming import run as R
from motorpool.streaming import stateful as ST

T0 = datetime(2024, 1, 1)


def in_files(spark, path, rows, schema, parts):
    """Consecutive slices as one file each, read one per micro-batch."""
    import os
    import time

    size = -(-len(rows) // parts)
    for i in range(parts):
        part = rows[i * size:(i + 1) * size]
        if not part:
            continue
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        now = time.time() - 1000 + i * 10
        for f in os.listdir(path):
            full = f"{path}/{f}"
            if f.endswith(".parquet") and os.path.getmtime(full) > time.time() - 900:
                os.utime(full, (now, now))
    return file_source(spark, path, spark.createDataFrame([], schema).schema, max_files=1)


ALERT_SCHEMA = "source_id string, ts timestamp, event_id long, severity string, comp double, top_features string, module string"


@pytest.mark.parametrize("parts", [1, 3])
def test_alert_stream_is_the_state_machine(spark, tmp_path, parts):
    rows = fault_rows(300, seed=21)
    src = in_files(spark, str(tmp_path / "in"), [(*r, "m") for r in rows], ALERT_SCHEMA, parts)
    table = UpsertTable(spark, str(tmp_path / "alerts"), ["alert_id"])
    R.upsert_sink(ST.alerts(src), table, str(tmp_path / "state")).awaitTermination()
    got = table.read().collect()
    want = machine(rows)
    show = lambda r: (r.source_id, r.status, r.alert_start_ts, r.alert_end_ts, r.peak_anomaly_ts, r.max_composite_score)
    assert sorted(map(show, got), key=str) == sorted((w[:6] for w in want), key=str)
    totals = {(w[0], w[2]): w[6] for w in want}
    for r in got:
        assert all(round(totals[r.source_id, r.alert_start_ts][k], 4) == v for k, v in r.top_10_features.items())


def test_smoothing_stream_equals_fold(spark, tmp_path):
    rows = [("s" if i % 3 else "u", "m", T0 + timedelta(seconds=i), i, (i * 37 % 101) / 10, (i * 53 % 100) / 100) for i in range(240)]
    schema = "source_id string, module string, ts timestamp, event_id long, error double, risk double"
    src = in_files(spark, str(tmp_path / "in"), rows, schema, 3)
    streamed = {r.event_id: (round(r.ema, 9), r.persistence) for r in drain(ST.smooth(src), "smooth").collect()}
    s = Series(spark.createDataFrame(rows, schema), ["source_id", "module"], ["ts", "event_id"])
    s = W.persistence(W.ema(s, F.col("error")), "risk")
    assert streamed == {r.event_id: (round(r.ema, 9), r.persistence) for r in s.result().collect()}


def test_health_stream_equals_batch(spark, tmp_path):
    mods = ["engine", "transmission", "tyre"]
    rows = [(f"s{i % 2}", mods[i * 7 % 3], T0 + timedelta(seconds=71 * i), i, float(i * 13 % 100), {"x": float(i % 5), f"y{i % 3}": 1.0}) for i in range(120)]
    schema = "source_id string, module string, ts timestamp, event_id long, health double, features map<string,double>"
    src = in_files(spark, str(tmp_path / "in"), rows, schema, 3)
    kept = ST.latest_payloads(drain(ST.health_windows(src), "health"), ["source_id", "gold_window_ts"])
    cols = ["source_id", "gold_window_ts", "vehicle_health_score", "engine_contrib", "transmission_contrib", F.to_json("top_5_features")]
    batch = H.gold_health(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, kept.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_ttl_lets_a_key_in_again(spark, tmp_path):
    at = [0, 10, 59, 61, 100, 122]
    rows = [("h", T0 + timedelta(minutes=m), i) for i, m in enumerate(at)] + [("g", T0, 90)]
    src = in_files(spark, str(tmp_path / "in"), rows, "row_hash string, ts timestamp, event_id long", 1)
    got = {r.event_id: r.accepted for r in drain(DD.outcomes(src, "row_hash", "ts", "event_id", 3600), "ttl").collect()}
    assert got == {0: True, 1: False, 2: False, 3: True, 4: False, 5: True, 90: True}


def test_dedup_across_micro_batches(spark, tmp_path):
    rows = [(f"h{i % 40}", T0 + timedelta(seconds=i)) for i in range(120)]
    src = in_files(spark, str(tmp_path / "in"), rows, "row_hash string, ts timestamp", 3)
    assert drain(DD.dedup(src, ts="ts").select("row_hash"), "dd").count() == 40


def test_late_first_occurrences_come_out(spark, tmp_path):
    rows = [("a", T0 + timedelta(hours=10)), ("b", T0 + timedelta(hours=11)), ("late", T0), ("a", T0 + timedelta(hours=12))]
    src = in_files(spark, str(tmp_path / "in"), rows, "row_hash string, ts timestamp", 4)
    DD.dedup_sink(src, str(tmp_path / "out"), str(tmp_path / "state"), ts="ts").awaitTermination()
    assert sorted(r.row_hash for r in spark.read.parquet(str(tmp_path / "out" / "v*")).collect()) == ["a", "b", "late"]


def test_dedup_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    schema, out = "row_hash string, ts timestamp", tmp_path / "out"
    keys = [f"h{i}" for i in range(30)] + [None]
    bucket = {r.k: r.b for r in spark.createDataFrame([(k,) for k in keys], "k string").selectExpr("k", "pmod(xxhash64(k), 8) as b").collect()}
    start = lambda src: DD.dedup_sink(src, str(out), str(tmp_path / "state"), ts="ts", buckets=8)
    step = lambda rows: R.in_steps(spark, [spark.createDataFrame(rows, schema).coalesce(1)], str(tmp_path / "in"), start)
    step([(k, T0) for k in keys])
    again = [k for k in keys if bucket[k] == bucket["h0"]]
    others = [f for f in (out / "keys" / "v0").rglob("*.parquet") if f.parent.name != f"bucket={bucket['h0']}"]
    spoiled = {f: f.read_bytes() for f in [*others, *(out / "v0").glob("*.parquet")]}
    for f in spoiled:  # whoever opens these fails
        f.with_name(f".{f.name}.crc").unlink()
        f.write_bytes(b"no parquet")
    step([(k, T0 + timedelta(days=1)) for k in again] * 2)
    assert len(others) == len(set(bucket.values())) - 1 and spark.read.schema(schema).parquet(str(out / "v1")).count() == 0
    for f, kept in spoiled.items():
        f.write_bytes(kept)
    step([(None, T0), ("new", T0), ("h1", T0), ("new", T0 - timedelta(days=2))])
    rows = spark.read.schema(schema).parquet(str(out / "v*")).collect()
    assert sorted(str(r.row_hash) for r in rows) == sorted(map(str, [*keys, "new"]))
    assert {r.ts for r in rows if r.row_hash == "new"} == {T0 - timedelta(days=2)}


def test_dedup_knows_versions_without_key_folders(spark, tmp_path):
    schema, out = "row_hash string, ts timestamp", tmp_path / "out"
    spark.createDataFrame([("old", T0), (None, T0)], schema).write.parquet(str(out / "v0"))
    src = in_files(spark, str(tmp_path / "in"), [("old", T0), ("fresh", T0), (None, T0)], schema, 1)
    DD.dedup_sink(src, str(out), str(tmp_path / "state"), ts="ts").awaitTermination()
    assert sorted(str(r.row_hash) for r in spark.read.parquet(str(out / "v*")).collect()) == ["None", "fresh", "old"]


def test_updates_after_a_reset_win(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ["k"], keep=2)
    for run in range(2):
        src = in_files(spark, str(tmp_path / f"in{run}"), [(k, run * 10 + k) for k in range(run, 4)], "k int, seq int", 2)
        R.upsert_sink(src, table, str(tmp_path / "state")).awaitTermination()
        R.archive_checkpoint(spark, str(tmp_path / "state"))
    assert {r.k: r.seq for r in table.read().collect()} == {0: 0, 1: 11, 2: 12, 3: 13}
    assert len(table.versions()) == 2


def test_malformed_rows_are_kept_apart(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{oops",), ('{"a":"x"}',)], "value string")
    good, bad = DD.tolerant(df, "a bigint")
    assert good.count() == 1 and bad.count() == 2


def test_checkpoint_reset_sets_the_old_one_aside(spark, tmp_path):
    src = in_files(spark, str(tmp_path / "in"), [(1,), (2,)], "a int", 1)
    state = str(tmp_path / "state")
    for _ in range(2):
        q = src.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    kept = R.archive_checkpoint(spark, state)
    assert kept and (tmp_path / "state").exists() is False and R.archive_checkpoint(spark, state) is None


def test_metrics_document_is_json():
    m = R.ProgressMetrics()
    m.streams["q"] = {"status": "RUNNING", "total_rows": 3}
    assert json.loads(m.document()) == {"streams": {"q": {"status": "RUNNING", "total_rows": 3}}}

"""Operators with rings, timers and replay-safe sinks, over several micro-batches, against batch forms and loops."""

import json
import os
import random
from collections import Counter, OrderedDict, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpool.operators import reuse
from motorpool.operators import windows as W
from motorpool.operators.series import Series
from motorpool.plans import health as H
from motorpool.plans import models as M
from motorpool.plans import observe as O
from motorpool.sources.streams import append_sink
from motorpool.streaming import processors as P
from motorpool.streaming import run as R
from motorpool.streaming import sinks as S

T0 = datetime(2024, 1, 1)


def _slices(rows, schema, spark, parts):
    size = -(-len(rows) // parts)
    return [spark.createDataFrame(rows[i : i + size], schema) for i in range(0, len(rows), size)]


# -- reuse distance


def test_earlier_smaller_counts_by_merging():
    for n in (0, 1, 63, 64, 65, 1000):
        v = np.random.default_rng(n).integers(-1, 40, n)
        assert reuse.earlier_smaller(v).tolist() == [int((v[:i] < v[i]).sum()) for i in range(n)]


@pytest.mark.parametrize("block", [41, 1_000_000])
def test_capacity_is_a_least_recently_used_store(spark, block):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, "hot", "hot", "hot", *[f"k{x}" for x in range(30)]]), 7) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k string, distance long")
    for capacity in (1, 6, 100):
        store, want = OrderedDict(), {}
        for i, k, _ in rows:
            want[i] = k not in store
            store[k] = True
            store.move_to_end(k)
            if len(store) > capacity:
                store.popitem(last=False)
        got = reuse.capacity_outcomes(df, "k", ["id"], capacity, block)
        assert {r.id: r.accepted for r in got.collect()} == want
    assert reuse.capacity_outcomes(df.limit(0), "k", ["id"], 3).count() == 0


# -- window error


def test_window_error_goes_on_across_batches(spark, tmp_path):
    rnd = random.Random(4)
    schema = "source_id string, module string, ts timestamp, event_id long, a double, b double"
    rows = [
        (f"s{rnd.randrange(3)}", "m", T0 + timedelta(seconds=i // 2), i, None if rnd.random() < 0.3 else rnd.random() * 9, None if i < 60 or rnd.random() < 0.2 else rnd.random())
        for i in range(500)
    ]
    means, scales = {"a": 4.0, "b": 0.5}, [(4.0, 2.0), (0.5, 0.3)]
    components = [[0.6], [0.8]]

    def start(src):
        out = P.window_errors(src, ["a", "b"], [4.0, 0.5], scales, components)
        return append_sink(out, str(tmp_path / "out"), str(tmp_path / "state"), "we", trigger={"availableNow": True})

    with P.state_store(spark):
        queries = R.in_steps(spark, _slices(rows, schema, spark, 6), str(tmp_path / "in"), start)
    assert len(queries) == 6
    s = W.impute(Series(spark.createDataFrame(rows, schema), ["source_id", "module"], ["ts", "event_id"]), means)
    scaler = M.Scaler(["a", "b"], {"a": 4.0, "b": 0.5}, {"a": 2.0, "b": 0.3})
    want = M.window_error(s.with_df(M.residuals(scaler.apply(s.df), ["a", "b"], components)), ["a", "b"]).result()
    got = {r.event_id: r.error for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(got) == 500 and all(abs(got[r.event_id] - r.error) < 1e-9 for r in want.collect())


def test_the_store_provider_is_put_back(spark):
    before = spark.conf.get(P._PROVIDER)
    with pytest.raises(ZeroDivisionError), P.state_store(spark):
        assert "RocksDB" in spark.conf.get(P._PROVIDER)
        1 / 0
    assert spark.conf.get(P._PROVIDER) == before


# -- closed windows

HEALTH = "source_id string, module string, ts timestamp, event_id long, health double, features map<string,double>"


def _health_rows(n, vehicles=3, step=70):
    rnd = random.Random(n)
    return [(f"v{rnd.randrange(vehicles)}", rnd.choice(["engine", "transmission"]), T0 + timedelta(seconds=step * i), i, float(rnd.randrange(101)), {"x": i / 7}) for i in range(n)]


def test_windows_close_once_and_silent_vehicles_are_forgotten(spark, tmp_path):
    rows = _health_rows(120)
    end = rows[-1][2]
    # two lone rows much later: the first moves the watermark past the silence, the second lets its own batch end
    later = [("z", "engine", end + timedelta(days=3), 900, 50.0, {}), ("z", "engine", end + timedelta(days=6), 901, 50.0, {})]
    parts = [*_slices(rows, HEALTH, spark, 3), *[spark.createDataFrame([r], HEALTH) for r in later]]

    def start(src):
        out = P.closed_health_windows(src, silence_seconds=86_400)
        return append_sink(out, str(tmp_path / "out"), str(tmp_path / "state"), "cw", trigger={"availableNow": True})

    with P.state_store(spark):
        queries = R.in_steps(spark, parts, str(tmp_path / "in"), start)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    gold = H.gold_health(spark.createDataFrame(rows, HEALTH)).collect()
    mine = {(r.source_id, r.gold_window_ts): (r.vehicle_health_score, r.engine_contrib, r.transmission_contrib) for r in got if r.source_id != "z"}
    assert len(mine) == sum(r.source_id != "z" for r in got)
    assert mine == {(r.source_id, r.gold_window_ts): (r.vehicle_health_score, r.engine_contrib, r.transmission_contrib) for r in gold}
    # one vehicle is left; its state counts as the row itself and its timer
    held = [op.numRowsTotal for q in queries for p in q.recentProgress for op in p.stateOperators]
    counts = [p.stateOperators[0].customMetrics for p in queries[-1].recentProgress if p.stateOperators]
    assert max(held) >= 3 and held[-1] < max(held) and counts


# -- observer cards


def test_cards_keep_the_newest_rows_of_each_module(spark, tmp_path):
    from motorpool.sources.tables import UpsertTable

    rnd = random.Random(3)
    schema = "source_id string, module string, ts timestamp, event_id long, latency double, payload string, ok boolean"
    rows = [(f"v{rnd.randrange(4)}", rnd.choice("ab"), T0 + timedelta(seconds=i // 3), i, None if i % 5 == 0 else float(i % 17), f"p{i}", rnd.random() < 0.8) for i in range(300)]
    rows.append(("only rejected", "a", T0, 999, 1.0, "x", False))
    table = UpsertTable(spark, str(tmp_path / "cards"), ["source_id"])

    def start(src):
        return R.upsert_sink(P.observer_cards(src.filter("ok"), src.filter("not ok"), keep=7), table, str(tmp_path / "state"), mode="update")

    with P.state_store(spark):
        R.in_steps(spark, _slices(rows, schema, spark, 4), str(tmp_path / "in"), start)
    cards = {r.source_id: r for r in table.read().collect()}
    for v in {r[0] for r in rows}:
        good = [r for r in rows if r[0] == v and r[6]]
        card = cards[v]
        assert (card.accepted, card.rejected) == (len(good), sum(r[0] == v and not r[6] for r in rows))
        assert (card.latency_sum, card.latency_rows) == (sum(r[4] or 0 for r in good), sum(r[4] is not None for r in good))
        assert card.last_seen == max((r[2] for r in good), default=None)
        want = defaultdict(list)
        for r in good:
            want[r[1]].append((r[2], r[3], r[5]))
        assert {m: [tuple(x) for x in h] for m, h in (card.history or {}).items()} == {m: h[-7:] for m, h in want.items()}


# -- sinks


def _uncommit(checkpoint):
    """A crash between the sink and the commit: the last batch runs again."""
    done = max((f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()), key=int)
    for name in (done, f".{done}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")


def test_split_sink_writes_every_row_once_after_a_replay(spark, tmp_path):
    schema = "id long, error string"
    parts = [spark.createDataFrame([(i, "bad" if i % 3 == 0 else None) for i in range(k, k + 20)], schema) for k in (0, 20, 40)]
    calls = []

    def check(rows):
        calls.append(1)
        return rows

    def start(src):
        return S.split_sink(src, check, str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "state"), lambda bad: bad.select("id", "error", "day"), F.when(F.col("id") % 2 == 0, "2024-01-01"))

    R.in_steps(spark, parts, str(tmp_path / "in"), start)
    _uncommit(tmp_path / "state")
    R.in_steps(spark, [], str(tmp_path / "in"), start)
    from motorpool.sources.streams import file_source

    start(file_source(spark, str(tmp_path / "in"), parts[0].schema)).awaitTermination()
    assert len(calls) == 4
    good = Counter(r.id for r in spark.read.parquet(str(tmp_path / "good/v*")).collect())
    dead = Counter(r.id for r in spark.read.schema("id long, error string, version long, day string").json(str(tmp_path / "dead")).collect())
    assert good == Counter(i for i in range(60) if i % 3) and dead == Counter(i for i in range(60) if i % 3 == 0)


def test_late_rows_restate_their_windows(spark, tmp_path):
    rows = _health_rows(150, vehicles=4)
    late = [r for r in rows if r[3] % 9 == 0]
    early = [r for r in rows if r[3] % 9]
    parts = [*_slices(early, HEALTH, spark, 2), spark.createDataFrame(late, HEALTH), spark.createDataFrame([("new", "engine", T0, 500, 3.0, {"x": 1.0})], HEALTH)]

    def start(src):
        return S.restating_sink(src, str(tmp_path / "bronze"), str(tmp_path / "gold"), str(tmp_path / "state"), buckets=4)

    R.in_steps(spark, parts, str(tmp_path / "in"), start)
    from motorpool.sources.streams import file_source

    _uncommit(tmp_path / "state")
    start(file_source(spark, str(tmp_path / "in"), parts[0].schema)).awaitTermination()
    pick = ["source_id", "gold_window_ts", "vehicle_health_score", "engine_contrib", "transmission_contrib"]
    got = Counter(tuple(r) for r in S.current_gold(spark, str(tmp_path / "gold")).select(*pick).collect())
    whole = spark.createDataFrame([*rows, ("new", "engine", T0, 500, 3.0, {"x": 1.0})], HEALTH)
    assert got == Counter(tuple(r) for r in H.gold_health(whole).select(*pick).collect())
    last = spark.read.parquet(str(tmp_path / "gold")).filter("version = 3")
    assert {r.source_id for r in last.collect()} == {"new"}


# -- counters and sketches


def test_observed_counters_are_those_of_the_batch(spark, tmp_path):
    rows = spark.createDataFrame([(i, "ab"[i % 2], ["accepted", "invalid", "duplicate"][i % 3]) for i in range(90)], "id long, module string, outcome string")
    listener = R.ProgressMetrics()
    spark.streams.addListener(listener)

    def start(src):
        return append_sink(R.counted(src, "c", "outcome", "module", ["a", "b"]), str(tmp_path / "out"), str(tmp_path / "state"), "counted", trigger={"availableNow": True})

    try:
        R.in_steps(spark, [rows.filter("id < 40"), rows.filter("id >= 40")], str(tmp_path / "in"), start)
        from motorpool.catalog.streamqueries import _await

        _await(lambda: listener.streams.get("counted", {}).get("observed", {}).get("b.attempted", 0) >= 45)
    finally:
        spark.streams.removeListener(listener)
    seen = listener.streams["counted"]["observed"]
    for r in O.counters(rows, "outcome", ["module"]).collect():
        assert [seen[f"{r.module}.{k}"] for k in ("attempted", "accepted", "failed_validation", "rejected")] == list(r[1:])
    assert json.loads(listener.document())


def test_sketches_roll_up_within_their_error(spark):
    rows = spark.range(40_000).selectExpr("id % 2 as module", "id % 30 as day", "id % 9000 as vehicle", "cast(id as double) as x")
    rolled = {r.module: r for r in O.rolled_up(O.sketches(rows, ["module", "day"], "vehicle", "x"), ["module"], {"p10": 0.1, "p50": 0.5}).collect()}
    for r in rolled.values():
        assert r.rows == 20_000 and abs(r.distinct_values / 4500 - 1) < 0.03
        assert abs(r.p50 / 40_000 - 0.5) < 0.01 and abs(r.p10 / 40_000 - 0.1) < 0.01

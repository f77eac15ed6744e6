"""Alerts, health, trips and attribution against plain loops."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from motorpool.functions import geo
from motorpool.functions.numeric import round_py
from motorpool.operators.series import Series
from motorpool.plans import alerts as AL
from motorpool.plans import health as H
from motorpool.plans import trips as T

DELTA = {"CRITICAL": 20, "WARNING": 5, "NORMAL": -10}
T0 = datetime(2024, 1, 1)


def fault_rows(n=400, seed=3):
    rnd = random.Random(seed)
    rows, mood = [], 0.5
    for i in range(n):
        mood = min(1, max(0, mood + rnd.uniform(-0.2, 0.2)))
        sev = "CRITICAL" if rnd.random() < mood * 0.6 else "WARNING" if rnd.random() < 0.3 else "NORMAL"
        key = rnd.choice(["v1", "v1", "v1", "v2"])
        rows.append((key, T0 + timedelta(minutes=i // 2), i, sev, round(rnd.random(), 3), json.dumps({"a": float(i % 7), f"f{i % 13}": 1.0})))
    return rows


def machine(rows):
    """The alert state machine, row by row."""
    out, state = [], {}
    for key, ts, _i, sev, comp, feats in rows:
        s = state.setdefault(key, {"score": 0, "active": False, "start": None, "peak": None, "top": 0.0, "f": {}})
        s["score"] = min(100, max(0, s["score"] + DELTA[sev]))
        if s["score"] > 0:
            for k, v in json.loads(feats).items():
                s["f"][k] = s["f"].get(k, 0) + v
            s["start"] = s["start"] or ts
            if comp > s["top"]:
                s["top"], s["peak"] = comp, ts
            s["active"] = s["active"] or s["score"] >= 100
        else:
            if s["active"]:
                out.append((key, "CLOSED", s["start"], ts, s["peak"], s["top"], s["f"]))
            state[key] = {"score": 0, "active": False, "start": None, "peak": None, "top": 0.0, "f": {}}
    out += [(k, "OPEN", s["start"], None, s["peak"], s["top"], s["f"]) for k, s in state.items() if s["active"]]
    return out


@pytest.mark.parametrize("target", [10**9, 60])
def test_episodes_are_the_state_machine(spark, target):
    rows = fault_rows()
    df = spark.createDataFrame(rows, "source_id string, ts timestamp, i long, severity string, comp double, feats string")
    got = AL.episodes(Series(df, ["source_id"], ["ts", "i"], target), "feats").collect()
    want = machine(rows)
    assert len(want) > 2
    show = lambda r: (r.source_id, r.status, r.alert_start_ts, r.alert_end_ts, r.peak_anomaly_ts, r.max_composite_score)
    assert sorted(map(show, got), key=str) == sorted((w[:6] for w in want), key=str)
    by_start = {(w[0], w[2]): w[6] for w in want}
    for r in got:
        full = by_start[r.source_id, r.alert_start_ts]
        assert len(r.top_10_features) == min(10, len(full))
        assert all(round(full[k], 4) == v for k, v in r.top_10_features.items())


def test_fold_table_function_agrees(spark):
    df = spark.createDataFrame(fault_rows(seed=9), "source_id string, ts timestamp, i long, severity string, comp double, feats string")
    s = Series(df, ["source_id"], ["ts", "i"])
    cols = ["source_id", "status", "alert_start_ts", "alert_end_ts", "peak_anomaly_ts", "max_composite_score"]
    rows = lambda d: sorted(map(tuple, d.select(*cols).collect()), key=str)
    assert rows(AL.episodes(s)) == rows(AL.episodes_by_fold(s))


@pytest.mark.parametrize("target", [None, 40])
def test_traceback_is_the_range_join(spark, target):
    rnd = random.Random(5)
    bronze = [(rnd.choice("aab"), T0 + timedelta(minutes=rnd.randrange(120)), i) for i in range(300)]
    alerts = [(rnd.choice("aabz"), f"al{i}", T0 + timedelta(minutes=rnd.randrange(-5, 125))) for i in range(25)]
    b = spark.createDataFrame(bronze, "k string, ts timestamp, i long")
    a = spark.createDataFrame(alerts, "k string, alert string, peak timestamp")
    got = AL.traceback(a, b, "k", "alert", "peak", ["ts", "i"], rows=20, target_rows=target).collect()
    want = set()
    for k, name, peak in alerts:
        hist = sorted((ts, i) for kk, ts, i in bronze if kk == k and ts <= peak)[-20:]
        want |= {(name, i, pos) for pos, (_, i) in enumerate(hist)}
    assert {(r.alert, r.i, r.pos) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("target", [None, 20])
def test_health_fusion_is_the_loop(spark, target):
    rnd = random.Random(11)
    rows = []
    for i in range(250):
        mod = rnd.choice(["engine", "transmission", "tyre"])
        h = round(rnd.uniform(0, 100), 3)
        rows.append((rnd.choice(["s1", "s1", "s2"]), mod, T0 + timedelta(seconds=97 * i), i, h, {"x": h / 10, f"y{i % 4}": h / 20}))
    df = spark.createDataFrame(rows, "source_id string, module string, ts timestamp, event_id long, health double, features map<string,double>")
    fusion = H.Fusion(penalties={"engine": 40.0})
    wins = H.carried_windows(H.module_windows(df, fusion.weights), fusion.weights, target)
    got = {
        (r.source_id, r.window_ts): (r.vehicle_health_score, r.engine_contrib, r.f)
        for r in H.with_top_features(H.fused(wins, fusion), fusion, "f").collect()
    }
    cache, want = {}, {}
    for s, m, ts, _i, h, f in sorted(rows, key=lambda r: r[2]):
        if m not in fusion.weights:
            continue
        cache.setdefault(s, {})[m] = (h, f)
        win = datetime.fromtimestamp(math.floor(ts.timestamp() / 300) * 300)
        total, pool = 0.0, []
        for mod, w in fusion.weights.items():
            hh, ff = cache[s].get(mod, (100.0, {}))
            total += hh * w
            pool += [(k, v * w) for k, v in ff.items()]
        eng = round(cache[s].get("engine", (100.0,))[0], 2)
        if eng < 40:
            total = min(total, eng)
        pool.sort(key=lambda p: p[1], reverse=True)
        want[s, win] = (round(total, 2), eng, {k: round(v, 4) for k, v in pool[:5]})
    assert got == want


def test_round_py_is_pythons_round(spark):
    rnd = random.Random(2)
    vals = [rnd.randrange(-10**6, 10**6) / 1000 for _ in range(500)] + [2.675, 0.125, 0.375, -0.125, 97.725, 1e9 + 0.005]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select("v", round_py(F.col("v"), 2).alias("r")).collect()
    assert all(r.r == round(r.v, 2) for r in got)


def trip_rows(n=300, seed=4):
    rnd = random.Random(seed)
    return [
        ("v", i, rnd.random() < 0.04, rnd.random() < 0.04, rnd.random() < 0.04, rnd.choice([0.0, 40.0, 90.0, 260.0, 700.0]))
        for i in range(n)
    ]


@pytest.mark.parametrize("target", [10**9, 50])
def test_driver_score_is_the_loop(spark, target):
    rows = trip_rows()
    df = spark.createDataFrame(rows, "vehicle string, i long, braking boolean, accel boolean, cornering boolean, dist double")
    got = [r.score for r in T.driver_score(Series(df, ["vehicle"], ["i"], target)).result().orderBy("i").collect()]
    score, clean, want = 100.0, 0.0, []
    for _v, _i, b, a, c, d in rows:
        hit = 5.0 * b + 3.0 * a + 5.0 * c
        if hit:
            score, clean = score - hit, 0.0
        else:
            clean += d
            if clean >= 250:
                score, clean = score + 1, clean - 250
        score = min(100.0, max(0.0, score))
        want.append(score)
    assert got == want


def test_corrected_levelling_removes_the_tilt(spark):
    m = (0.3, -0.2, 0.9)
    cols = [F.lit(v) for v in m]
    x, y, z = geo.levelled(*cols, *cols, corrected=True)
    r = spark.range(1).select(x.alias("x"), y.alias("y"), z.alias("z")).first()
    assert abs(r.x) < 1e-12 and abs(r.y) < 1e-12 and abs(r.z - math.sqrt(sum(v * v for v in m))) < 1e-12


def test_nearest_road_is_brute_force(spark):
    rnd = random.Random(8)
    pts = [(i, 77 + rnd.random() / 20, 28 + rnd.random() / 20) for i in range(60)]
    roads = [(r, f"c{r % 3}", s, 77 + rnd.random() / 20, 28 + rnd.random() / 20) for r in range(12) for s in range(3)]
    p = spark.createDataFrame(pts, "id long, lon double, lat double")
    rd = spark.createDataFrame(roads, "road_id long, fclass string, seq int, lon double, lat double")
    got = {r.id: (r.road_id, r.road_type) for r in T.nearest_road(p, rd, ["id"]).collect()}

    def dist(px, py, ax, ay, bx, by):
        dx, dy = bx - ax, by - ay
        t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - ax - t * dx, py - ay - t * dy)

    for i, lon, lat in pts:
        best = min((dist(lon, lat, *roads[3 * r + s][3:], *roads[3 * r + s + 1][3:]), r) for r in range(12) for s in range(2))
        assert got[i] == (best[1], f"c{best[1] % 3}")


def test_cells_along_a_segment_hold_all_near_points_and_grow_with_its_length(spark):
    rnd, cell = random.Random(8), 0.01
    ends = [(77.0, 28.0, 78.0, 29.0), (77.5, 28.0, 77.5, 29.0), (77.0, 28.3, 78.0, 28.3), (77.2, 28.2, 77.2, 28.2), (77.3, 28.9, 77.300001, 28.1),
            (77.9, 28.1, 77.85, 28.9)] + [tuple(rnd.uniform(77, 78) for _ in range(4)) for _ in range(10)]
    seg = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "road_id int, x1 double, y1 double, x2 double, y2 double")
    cells = {}
    for r in T.cells_along(seg, cell).collect():
        cells.setdefault(r.road_id, []).append((r.cx, r.cy))
    for i, (x1, y1, x2, y2) in enumerate(ends):
        assert len(set(cells[i])) == len(cells[i]) <= 16 + 4 * (abs(x2 - x1) + abs(y2 - y1)) / cell
        for _ in range(500):
            u, turn, far = rnd.random(), rnd.uniform(0, 2 * math.pi), rnd.choice([rnd.random(), 0.999999])
            x, y = x1 + u * (x2 - x1) + far * cell * math.cos(turn), y1 + u * (y2 - y1) + far * cell * math.sin(turn)
            assert (math.floor(x / cell), math.floor(y / cell)) in cells[i]


def test_far_points_have_a_road_too(spark):
    p = spark.createDataFrame([(1, 77.0, 28.0), (2, 77.05, 28.0), (3, 79.5, 28.0), (4, None, 28.0)], "id long, lon double, lat double")
    rd = spark.createDataFrame([(7, "a", 0, 77.0, 28.0), (7, "a", 1, 77.0, 28.001), (8, "b", 0, 95.0, 28.0), (8, "b", 1, 95.0, 28.1)], "road_id long, fclass string, seq int, lon double, lat double")
    assert {r.id: r.road_id for r in T.nearest_road(p, rd, ["id"]).collect()} == {1: 7, 2: 7, 3: 7, 4: None}
    assert {r.road_type for r in T.nearest_road(p, rd.limit(0), ["id"]).collect()} == {"unknown"}


@pytest.mark.parametrize("target", [60])
def test_trip_pipeline_with_a_hot_vehicle(spark, target):
    """Numbering, segments, distances, grade, yaw and scores agree between plain and chunked series."""
    rnd = random.Random(13)
    rows, clock = [], 0.0
    for i in range(260):
        clock += rnd.choice([4.0, 4.0, 4.0, 40.0, 90000.0 if i % 60 == 59 else 4.0])
        rows.append((
            "hot" if rnd.random() < 0.8 else "cold", datetime.fromtimestamp(1.7e9 + clock), i, clock, float(rnd.randrange(0, 4) * 30), rnd.uniform(-0.6, 0.6),
            rnd.uniform(-0.6, 0.6), 1.0, 200.0 + rnd.randrange(9), 28 + rnd.random() / 100, 77 + rnd.random() / 100,
        ))
    df = spark.createDataFrame(
        rows, "vehicle string, ts timestamp, event_id long, t double, speed double, ax double, ay double, az double, alt double, lat double, lon double"
    )

    def go(n):
        s = T.trip_deltas(T.number_trips(Series(df, ["vehicle"], ["ts", "event_id"], n), "ts", 8), dt=("t", None))
        s = T.yaw_rate(T.heading(T.grade(T.with_distance(T.segments(T.level(s))))))
        s = T.trip_deltas(s, ("trip", "segment"), dv=("speed", None))
        s = s.with_df(s.df.withColumn("ax_true", F.col("ax_cal") + F.sin("grade")))
        s = T.driver_score(s.with_df(s.df.withColumns(T.harsh_events(F.lit("primary")))))
        cols = ["event_id", "trip", "segment", *[F.round(c, 9) for c in ("dt", "dist", "grade", "heading", "yaw", "ax_cal", "dv")], "braking", "accel", "cornering", "score"]
        return sorted(map(tuple, s.result().select(*cols).collect()))

    assert go(target) == go(10**9)

"""Model jobs against numpy."""

import numpy as np
from pyspark.sql import functions as F

from motorpool.operators.series import Series
from motorpool.plans import dtc as D
from motorpool.plans import models as M

RNG = np.random.default_rng(7)


def bronze(spark, n=120):
    x = RNG.normal(size=(n, 3)) @ np.array([[1, 0.5, 0], [0, 1, 0.2], [0, 0, 0.1]])
    rows = [("a" if i < 70 else "b", i, *map(float, x[i])) for i in range(n)]
    return x, spark.createDataFrame(rows, "k string, i long, p double, q double, r double")


def test_window_error_equals_padded_windows(spark):
    x, df = bronze(spark)
    f = ["p", "q", "r"]
    z = (x - x.mean(0)) / x.std(0)
    scaler = M.fit_scaler(df, f)
    pcs = M.fit_components(scaler.apply(df), f, 2)
    vec = np.array(pcs)
    want = {}
    for lo, hi in ((0, 70), (70, 120)):
        part = np.vstack([np.repeat(z[lo:lo + 1], 29, axis=0), z[lo:hi]])
        res = (part - part @ vec @ vec.T) ** 2
        for j in range(hi - lo):
            want[lo + j] = res[j:j + 30].mean()
    for target in (10**9, 25):
        s = Series(df, ["k"], ["i"], target)
        s = M.window_error(s.with_df(M.residuals(scaler.apply(s.df), f, pcs)), f)
        got = {r.i: r.error for r in s.result().collect()}
        assert all(abs(got[i] - w) < 1e-9 for i, w in want.items()) and len(got) == len(want)


def test_sensor_policy_masks_or_sets_apart(spark):
    f, lacks = ["p", "q", "r"], {"ok": [], "mask": ["q"], "abort": ["p", "q"], None: ["r"]}
    x = RNG.normal(size=(4, 40, 3))
    rows = [
        (k, i, *[None if g in lacks[k] or (k == "ok" and g == "p" and i == 5) else float(x[n, i, j]) for j, g in enumerate(f)])
        for n, k in enumerate(lacks) for i in range(40)
    ]
    df = spark.createDataFrame(rows, "k string, i long, p double, q double, r double")
    fit, apart = M.by_sensors(df, ["k"], f, most=1)
    assert {(r.k, r.action, tuple(r.masked)) for r in fit.collect()} == {("ok", "ok", ()), ("mask", "mask", ("q",)), (None, "mask", ("r",))}
    assert [(r.k, sorted(r.masked)) for r in apart.distinct().select("k", "masked").distinct().collect()] == [("abort", ["p", "q"])]
    scaler = M.Scaler(f, dict(p=0.1, q=-0.2, r=0.3), dict(p=1.1, q=0.9, r=1.2))
    pcs = [[0.6, 0.0], [0.8, 0.6], [0.0, 0.8]]
    vec = np.array(pcs)
    for target in (10**9, 15):
        s = Series(fit, ["k"], ["i"], target)
        model = M.ModuleModel(scaler, pcs, M.Mixture([1.0], [[0, 0, 0]], [np.eye(3).tolist()]))
        got = {(r.k, r.i): r.error for r in M.raw_scores(s, model, F.col("masked")).result().collect()}
        assert len(got) == 120
        for n, k in enumerate(lacks):
            if k == "abort":
                continue
            z = x[n].copy()
            if k == "ok":
                z[5, 0] = z[4, 0]
            for g in lacks[k]:
                z[:, f.index(g)] = scaler.mean[g]
            z = (z - [scaler.mean[g] for g in f]) / [scaler.std[g] for g in f]
            own = (z - z @ vec @ vec.T) ** 2
            own[:, [f.index(g) for g in lacks[k]]] = 0
            own = np.concatenate([np.repeat(own[:1], 29, axis=0), own]).mean(axis=1)
            assert all(abs(got[k, i] - own[i : i + 30].mean()) < 1e-9 for i in range(40))
    assert M.by_sensors(df.limit(0), ["k"], f)[0].count() == 0


def test_log_density(spark):
    x, df = bronze(spark)
    mix = M.Mixture([0.3, 0.7], [[0, 0, 0], [1, 1, 0]], [np.eye(3).tolist(), np.diag([2.0, 1.0, 0.5]).tolist()])
    scaler = M.Scaler(["p", "q", "r"], dict.fromkeys("pqr", 0.0), dict.fromkeys("pqr", 1.0))
    got = [r.d for r in scaler.apply(df).select("i", M.log_density(mix, scaler.features).alias("d")).orderBy("i").collect()]

    def pdf(v):
        return sum(
            w * np.exp(-0.5 * (v - m) @ np.linalg.inv(c) @ (v - m)) / np.sqrt((2 * np.pi) ** 3 * np.linalg.det(c))
            for w, m, c in zip(mix.weights, map(np.array, mix.means), map(np.array, mix.covariances))
        )

    assert np.allclose(got, [np.log(pdf(v)) for v in x], atol=1e-4)


def test_full_scoring_has_one_row_per_input(spark):
    _, df = bronze(spark)
    s = Series(df, ["k"], ["i"])
    out = M.score_silver(s, M.fit_module(s, ["p", "q", "r"], k=2, mixture_k=2), "m").result()
    rows = out.collect()
    assert len(rows) == 120 and all(0 <= r.composite_score <= 1 and r.health_score == (1 - r.composite_score) * 100 for r in rows)
    assert all(r.severity_code == {"NORMAL": 0, "WARNING": 1, "CRITICAL": 2}[r.severity] for r in rows)


def test_classifier_separates_healthy_from_faulty(spark):
    rows = [(i, 50 + float(RNG.normal()), float(RNG.normal())) for i in range(600)]
    df = spark.createDataFrame(rows, "i long, temp double, other double")
    data = M.augment(df, "P0217", ["temp", "other"], ["i"]).cache()
    healthy, faulty = data.filter("target = 0"), data.filter("target > 0.9")
    assert faulty.agg(F.avg("temp")).first()[0] > healthy.agg(F.avg("temp")).first()[0] * 1.4
    assert data.count() == 600
    model = M.fit_code(data, "P0217", ["temp", "other"])
    p = lambda d: D.score_codes(d, [model]).agg(F.avg("P0217")).first()[0]
    assert p(healthy) < 0.25 and p(faulty) > 0.75


def test_augmentation_on_a_hot_series_is_the_same(spark):
    df = spark.range(400).select("id", (F.col("id") % 17).cast("double").alias("x"))
    rows = lambda t: sorted(map(tuple, M.augment(df, "P0420", ["x"], ["id"], t).collect()))
    assert rows(None) == rows(30)


def test_attribution_ends_at_one(spark):
    rows = [("s", i, c, abs((i * k) % 7) / 10) for i in range(50) for c, k in (("A", 3), ("B", 1))]
    out = D.attribute(spark.createDataFrame(rows, "s string, pos int, code string, p double"), "s")
    top = {r.code: r.m for r in out.groupBy("code").agg(F.max("risk").alias("m")).collect()}
    assert abs(max(top.values()) - 1.0) < 1e-12
    flat = spark.createDataFrame([("s", i, "A", 0.5) for i in range(5)], "s string, pos int, code string, p double")
    assert D.attribute(flat, "s").agg(F.max("risk")).first()[0] == 0.0

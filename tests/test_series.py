"""Ordered operators: cold keys, hot keys and plain loops must agree."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from motorpool.operators import windows as W
from motorpool.operators.fold import Affine, Clamp, clamp_inputs
from motorpool.operators.quantiles import exact_percentiles
from motorpool.operators.series import (
    Series, following, last_valid, next_valid, previous, run_max, run_min, run_sum, run_sum_back,
)


def skewed(spark, n=1500, seed=1):
    rnd = random.Random(seed)
    rows = [
        (rnd.choice(["a", "b", "b", "b", None, None]), i // 3, i, rnd.choice([20.0, 5.0, -10.0]), rnd.random() if rnd.random() < 0.7 else None) for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "k string, t long, i long, d double, v double")


@pytest.mark.parametrize("target", [100, 7])
def test_hot_keys_equal_plain_windows(spark, target):
    _, df = skewed(spark, 900)

    def go(target_rows):
        s = Series(df, ["k"], ["t", "i"], target_rows)
        assert s.hot == (target_rows < 1000)
        v, d = F.col("v"), F.col("d")
        s = s.running(
            a=run_sum(d), b=run_sum_back(d), c=run_min(v), e=run_max(v), f=previous(v), g=following(v), h=last_valid(v), j=next_valid(v)
        )
        s = s.indexed().rolling(5, 4, m=lambda w: F.percentile("v", F.lit(0.5)).over(w), n=lambda w: F.count("*").over(w))
        s = s.fold("score", Clamp(), F.lit(0.0), **clamp_inputs(d, 0, 100))
        s = s.fold("ema", Affine(), F.lit(0.0), a=F.lit(0.8), b=0.2 * F.coalesce(v, F.lit(0.0)))
        cols = ["k", "t", "i", "a", "b", "c", "e", "f", "g", "h", "j", "idx", "m", "n", "score", F.round("ema", 9)]
        return sorted(map(tuple, s.result().select(*cols).collect()), key=str)

    assert go(target) == go(10**9)


@pytest.mark.parametrize("outlier", [False, True])
def test_one_instant_and_a_wrong_clock_are_split(spark, outlier):
    t = F.when(F.lit(outlier) & (F.col("id") == 0), -10**9).otherwise(1)
    df = spark.range(6000).select(F.lit("k").alias("k"), t.alias("t"), F.col("id").alias("i"))
    s = Series(df, ["k"], ["t", "i"], 500)
    sizes = [r["count"] for r in s.df.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 1000
    s = s.running(n=run_sum(F.lit(1)))
    assert [r.n for r in s.result().orderBy("i").collect()] == list(range(1, 6001))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([20.0, 5.0, -10.0, 0.0]), min_size=1, max_size=200), st.integers(5, 60))
def test_clamp_fold_is_the_loop(spark, deltas, target):
    df = spark.createDataFrame([(0, i, d) for i, d in enumerate(deltas)], "k int, i long, d double")
    out = Series(df, ["k"], ["i"], target).fold("s", Clamp(), F.lit(0.0), **clamp_inputs(F.col("d"), 0, 100)).result()
    want, x = [], 0.0
    for d in deltas:
        x = min(100.0, max(0.0, x + d))
        want.append(x)
    assert [r.s for r in out.orderBy("i").collect()] == want


def test_window_operators_on_hot_keys(spark):
    _, df = skewed(spark, 600)

    def go(target):
        s = Series(df, ["k"], ["t", "i"], target)
        s = W.smooth_seams(W.interpolate(s, "v"), "d", rows=20, reach=3)
        s = W.rolling_mean_std(s, "d", 5)
        s = W.sequences(s, ["d"], 6)
        return sorted(
            (tuple(r) for r in s.result().select("k", "t", "i", F.round("v", 9), F.round("d", 9), F.round("d_mean", 9), F.round("d_std", 9), F.col("sequence").cast("string")).collect()),
            key=str,
        )

    assert go(40) == go(10**9)


def test_interpolation_matches_pandas(spark):
    import pandas as pd

    vals = [None, None, 1.0, None, None, None, 5.0, None, 9.0, None, None, None]
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(vals)], "k int, i long, v double")
    got = [r.v for r in W.interpolate(Series(df, ["k"], ["i"]), "v").result().orderBy("i").collect()]
    want = pd.Series(vals, dtype="float64").interpolate(method="linear", limit=2)
    assert pd.Series(got, dtype="float64").round(9).equals(want.round(9))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_percentiles_by_selection(spark, keys):
    _, df = skewed(spark, 3000)
    probs = {"p05": 0.05, "p50": 0.5, "p995": 0.995, "lo": 0.0, "hi": 1.0}
    plain = exact_percentiles(df, keys, "v", probs)
    picked = exact_percentiles(df, keys, "v", probs, limit=10, accuracy=200)
    rnd = lambda d: sorted((tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in d.collect()), key=str)
    assert rnd(plain) == rnd(picked) and len(rnd(plain)) == (3 if keys else 1)


def test_percentiles_of_nan_and_of_nothing(spark):
    rows = [("a", float("nan")), ("a", 1.0), ("a", 2.0), ("a", 4.0), (None, 3.0), (None, None), ("empty", None)] + [("n", float("nan"))] * 5
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p0": 0.0, "p40": 0.4, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    show = lambda d: sorted((str(tuple(r)) for r in d.collect()))
    assert show(exact_percentiles(df, ["k"], "v", probs)) == show(exact_percentiles(df, ["k"], "v", probs, limit=1, accuracy=100))


def test_percentiles_of_mostly_equal_values(spark):
    df = spark.range(2000).select((F.when(F.col("id") % 10 < 9, 1.0).otherwise(F.col("id").cast("double"))).alias("v"))
    probs = {"p50": 0.5, "p95": 0.95}
    assert exact_percentiles(df, [], "v", probs).collect() == exact_percentiles(df, [], "v", probs, limit=1, accuracy=100).collect()

"""Work that must not grow faster than the table: rows made once, lists kept small."""

import numpy as np
from pyspark.sql import functions as F

from motorpool.plans import models as M
from motorpool.plans import trips as T
from motorpool.sources.streams import append_sink
from motorpool.streaming import dedup as DD
from motorpool.streaming import processors as P
from motorpool.streaming import run as R


def counted_rows(spark, df, column):
    """``df`` and an accumulator of how many rows of ``column`` were made."""
    made = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def seen(s):
        made.add(len(s))
        return s

    return df.withColumn(column, seen(F.col(column))), made


def test_a_code_is_trained_on_rows_made_once(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(min(max(a + 0.1 * b, 0), 1))) for a, b in zip(rng.random(400), rng.random(400))]
    df, made = counted_rows(spark, spark.createDataFrame(rows, "qty double, disc double, target double"), "qty")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = M.fit_code(df, "P0001", ["qty", "disc"])
    assert model["coef"][0] > 1 and made.value == 400
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_faulty_rows_are_ranked_in_chunks(spark, monkeypatch):
    """The constant key of the one series over all faulty rows once had the name of a helper column, and no cut point held."""
    seen, plain = [], M.Series

    def series(df, keys, order, **options):
        seen.append(plain(df, keys, order, **options))
        return seen[-1]

    monkeypatch.setattr(M, "Series", series)
    df = spark.range(4000).select("id", F.col("id").cast("double").alias("value"))
    whole = M.augment(df, "P0217", ["value"], ["id"])
    parts = M.augment(df, "P0217", ["value"], ["id"], target_rows=200)
    sizes = [r["count"] for r in seen[-1].df.groupBy("_chunk").count().collect()]
    assert not seen[0].hot and seen[1].hot and len(sizes) > 5 and max(sizes) < 800
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_repeats_are_judged_bucket_by_bucket(spark, tmp_path):
    """3 000 keys in two micro-batches; the state has a row per bucket, and all rows get what a plain loop says."""
    rng = np.random.default_rng(5)
    rows = [(f"h{k}", int(1_700_000_000 + t), i) for i, (k, t) in enumerate(zip(rng.integers(0, 3000, 9000), rng.integers(0, 9000, 9000)))]
    rows += [(None, 1_700_000_000 + t, 9000 + t) for t in (5, 10, 7000)]
    rows.sort(key=lambda r: r[1])
    parts = [spark.createDataFrame(x, "k string, s long, i long").select("k", F.timestamp_seconds("s").alias("ts"), "i").coalesce(2) for x in (rows[:5000], rows[5000:])]
    seen, since, wanted = [], {}, {}

    def start(src):
        seen.append(append_sink(DD.outcomes(src, "k", "ts", "i", 1800), f"{tmp_path}/out", f"{tmp_path}/state", f"buckets{len(seen)}", trigger={"availableNow": True}))
        return seen[-1]

    R.in_steps(spark, parts, f"{tmp_path}/in", start)
    for k, s, i in sorted(rows, key=lambda r: (r[1], r[2])):
        wanted[i] = k not in since or s - since[k] > 1800
        since[k] = s if wanted[i] else since[k]
    assert {r.i: r.accepted for r in spark.read.parquet(f"{tmp_path}/out").collect()} == wanted
    assert max(o["numRowsTotal"] for q in seen for p in q.recentProgress for o in p["stateOperators"]) <= 1025


def test_roads_in_cells_stay_off_the_driver_and_ties_off_the_points(spark, monkeypatch):
    """300 roads lie on one another: a point gets one type, and nothing behind an explode is broadcast, however small it seems."""
    plans, plain = [], T.cut

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(T, "cut", keep)
    kinds = ("service", "primary", None)
    roads = spark.createDataFrame([(r, kinds[r % 3], k, 0.5 * k, 0.001 * (r // 299)) for r in range(300) for k in (0, 1)], "road_id int, fclass string, seq int, lon double, lat double")
    points = spark.createDataFrame([(i, 0.01 * (i % 40), 0.0005) for i in range(50)] + [(50, None, 1.0)], "id int, lon double, lat double")
    got = T.nearest_road_type(points, roads, ["id"])
    every = T.nearest_road(points, roads, ["id"])
    wanted = every.groupBy("id").agg(F.min("road_type").alias("road_type"))
    assert every.count() > 5000 and sorted(got.collect()) == sorted(wanted.collect())
    made = [p for p in plans if "explode(sequence" in p]
    assert len(made) >= 2 and not any("BroadcastExchange" in p for p in made)


def test_stores_hold_buckets_of_keys(spark, tmp_path):
    """2 000 vehicles with two modules each: a store has a row for each bucket at most, and every row its error and card."""
    rows = spark.range(8000).select(
        F.concat(F.lit("v"), F.col("id") % 2000).alias("source_id"), F.concat(F.lit("m"), F.floor(F.col("id") / 2000) % 2).alias("module"),
        F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("ts"), F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).cast("double").alias("a"),
    )
    seen = []

    def start(name, out, mode):
        q = out.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        seen.append(q)
        return q

    rows.coalesce(4).write.parquet(f"{tmp_path}/in")
    src = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    with P.state_store(spark):
        start("bucket_errors", P.window_errors(src(), ["a"], [4.0], [(5.0, 3.0)], [[0.0]]), "append").awaitTermination()
        good = src().select("source_id", "module", "ts", "event_id", F.col("a").alias("latency"), F.lit("x").alias("payload"))
        start("bucket_cards", P.observer_cards(good.where("event_id % 5 > 0"), good.where("event_id % 5 = 0"), keep=1), "update").awaitTermination()
    assert max(o["numRowsTotal"] for q in seen for p in q.recentProgress for o in p["stateOperators"]) <= P.BUCKETS
    assert spark.table("bucket_errors").count() == 8000
    cards = spark.table("bucket_cards").agg(F.count("*"), F.sum("accepted"), F.sum("rejected"), F.max(F.size("history"))).first()
    assert list(cards) == [2000, 6400, 1600, 2]


def test_a_mixture_is_fitted_as_sparks_own_in_few_passes_over_rows(spark):
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(m, s, (300, 2)) for m, s in ((0, 1), (6, 0.5), (-5, 2))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "z_p double, z_q double").coalesce(3)
    own = GaussianMixture(k=3, seed=42).fit(VectorAssembler(inputCols=["z_p", "z_q"], outputCol="features").transform(df))
    rows, made = counted_rows(spark, df, "z_p")
    mix = M.fit_mixture(rows, ["p", "q"])
    assert np.allclose(mix.weights, own.weights, atol=1e-7) and made.value == 900
    for r, m, c in zip(own.gaussiansDF.collect(), mix.means, mix.covariances):
        assert np.allclose(r["mean"].toArray(), m, atol=1e-7) and np.allclose(r["cov"].toArray(), c, atol=1e-7)

"""Window, top-n and operational aggregate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.goldqueries import _LAT, _SCORED, latencies, scored_silver
from motorpool.catalog.registry import Tables, query, r4, r6
from motorpool.functions import scoring, timefmt
from motorpool.operators import windows as W
from motorpool.operators.quantiles import exact_percentiles
from motorpool.operators.series import Series
from motorpool.plans import observe as O

_BW = "PARTITION BY source_id ORDER BY ts, okey, line, pkey, price"
_BID = ["source_id", "okey", "line", "pkey"]
_BSEL = ", ".join(_BID)


@query(
    "w5_rolling_mean_std_backfilled", views=["v_bronze"],
    sql=f"""WITH r AS (SELECT *, row_number() OVER w AS i, CASE WHEN count(qty) OVER f = 5 THEN avg(qty) OVER f END AS m, CASE WHEN count(qty) OVER f = 5 THEN stddev_samp(qty) OVER f END AS s
        FROM v_bronze WINDOW w AS ({_BW}), f AS ({_BW} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
        SELECT {_BSEL}, price, round(coalesce(m, first_value(m IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS qty_mean,
        round(coalesce(s, first_value(s IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS qty_std FROM r""",
)
def _(t: Tables):
    df = W.rolling_mean_std(t.bronze_series("qty"), "qty").result()
    return df.select(*_BID, "price", r6(F.col("qty_mean")).alias("qty_mean"), r6(F.col("qty_std")).alias("qty_std"))


@query(
    "w7_seam_smoothing", views=["v_bronze"],
    sql=f"""WITH r AS (SELECT *, row_number() OVER ({_BW}) - 1 AS i FROM v_bronze),
        g AS (SELECT *, CASE WHEN (i + 5) % 75 < 10 AND i + 5 >= 75 THEN (i + 5) // 75 END AS seam FROM r)
        SELECT {_BSEL}, price, round(CASE WHEN seam IS NULL THEN qty ELSE avg(qty) OVER (PARTITION BY source_id, seam ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END, 6) AS qty FROM g""",
)
def _(t: Tables):
    return W.smooth_seams(t.bronze_series("qty"), "qty").result().select(*_BID, "price", r6(F.col("qty")).alias("qty"))


_HOLES = "CASE WHEN okey % 10 < 4 THEN NULL ELSE qty END"


def _holed(t: Tables):
    s = t.bronze_series("qty")
    return s.with_df(s.df.withColumn("v", F.when(F.col("okey") % 10 >= 4, F.col("qty"))))


@query(
    "w8_limited_interpolation", views=["v_bronze"],
    sql=f"""WITH r AS (SELECT *, {_HOLES} AS v, row_number() OVER ({_BW}) AS i FROM v_bronze),
        n AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS lv, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS li,
          first_value(v IGNORE NULLS) OVER a AS rv, first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ri FROM r
          WINDOW b AS (PARTITION BY source_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY source_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT {_BSEL}, price, round(CASE WHEN v IS NOT NULL THEN v WHEN i - li <= 2 THEN coalesce(lv + (rv - lv) * (i - li) / (ri - li), lv) END, 6) AS v FROM n""",
)
def _(t: Tables):
    return W.interpolate(_holed(t), "v").result().select(*_BID, "price", r6(F.col("v")).alias("v"))


@query(
    "w9_forward_fill_impute", views=["v_bronze"],
    sql=f"""SELECT {_BSEL}, price, coalesce(last_value({_HOLES} IGNORE NULLS) OVER ({_BW}), 25.5::DOUBLE) AS v FROM v_bronze""",
)
def _(t: Tables):
    return W.impute(_holed(t), {"v": 25.5}).result().select(*_BID, "price", "v")


_SEQ = f"""SELECT {_BSEL}, price, len(q) AS n, round(list_sum(q), 4) AS total, q[1] AS oldest FROM (
    SELECT *, {{}} AS q FROM (SELECT *, list(qty) OVER ({_BW} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS s FROM v_bronze)) WHERE len(q) = 30"""


def _seq_out(s):
    q = F.transform("sequence", lambda v: v[0])
    total = F.aggregate(q, F.lit(0.0), lambda a, v: a + v)
    return s.result().select(*_BID, "price", F.size(q).cast("long").alias("n"), r4(total).alias("total"), q[0].alias("oldest"))


@query(
    "w10_padded_sequences", views=["v_bronze"],
    sql=_SEQ.format("list_concat(list_transform(range(30 - len(s)), lambda x: s[1]), s)"),
)
def _(t: Tables):
    return _seq_out(W.sequences(t.bronze_series("qty", "disc"), ["qty", "disc"]))


@query("w10_full_sequences", views=["v_bronze"], sql=_SEQ.format("s"))
def _(t: Tables):
    return _seq_out(W.sequences(t.bronze_series("qty", "disc"), ["qty", "disc"], pad=False))


def _ema_sql(first):
    return f"""WITH o AS MATERIALIZED (SELECT event_id, source_id, module, value AS x, row_number() OVER (PARTITION BY source_id, module ORDER BY ts, event_id) AS rn FROM v_silver),
    f AS (SELECT event_id, source_id, module, rn, {first} AS e FROM o WHERE rn = 1
      UNION ALL SELECT o.event_id, o.source_id, o.module, o.rn, 0.2::DOUBLE * o.x + 0.8::DOUBLE * f.e FROM f JOIN o ON o.source_id = f.source_id AND o.module = f.module AND o.rn = f.rn + 1)
    SELECT event_id, round(e, 6) AS ema FROM f"""


def _silver_series(t: Tables, *cols):
    return Series(t.silver.select("source_id", "module", "ts", "event_id", *cols), ["source_id", "module"], ["ts", "event_id"])


@query("w11_ema_zero_seed", views=["v_silver"], recursive=True, sql=_ema_sql("0.2::DOUBLE * x"))
def _(t: Tables):
    return W.ema(_silver_series(t, "value"), F.col("value")).result().select("event_id", r6(F.col("ema")).alias("ema"))


@query("w11_ema_first_value_seed", views=["v_silver"], recursive=True, sql=_ema_sql("x"))
def _(t: Tables):
    return W.ema(_silver_series(t, "value"), F.col("value"), seed=None).result().select("event_id", r6(F.col("ema")).alias("ema"))


@query(
    "w12_persistence_escalation", views=["v_silver"], recursive=True,
    sql=f"""WITH {_SCORED}, d AS (SELECT *, least(comp * 1.6::DOUBLE, 1.0) AS r FROM c),
        o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ts, event_id) AS rn FROM d),
        f AS (SELECT event_id, source_id, rn, r, (r >= 0.8)::INT AS cnt FROM o WHERE rn = 1
          UNION ALL SELECT o.event_id, o.source_id, o.rn, o.r, CASE WHEN o.r >= 0.8 THEN cnt + 1 WHEN o.r >= 0.5 THEN greatest(0, cnt - 1) ELSE 0 END
          FROM f JOIN o ON o.source_id = f.source_id AND o.rn = f.rn + 1)
        SELECT event_id, cnt::DOUBLE AS cnt, CASE WHEN cnt >= 5 THEN 'CRITICAL' WHEN r >= 0.5 THEN 'WARNING' ELSE 'NORMAL' END AS severity,
        round(CASE WHEN cnt >= 5 THEN greatest(r, 0.85) ELSE r END, 6) AS comp FROM f""",
)
def _(t: Tables):
    df = scored_silver(t).select("source_id", "ts", "event_id", F.least(F.col("comp") * 1.6, F.lit(1.0)).alias("r"))
    out = W.persistence(Series(df, ["source_id"], ["ts", "event_id"]), "r", "cnt").result()
    return out.select(
        "event_id", "cnt", scoring.escalated_severity(F.col("r"), F.col("cnt")).alias("severity"),
        r6(scoring.escalated_risk(F.col("r"), F.col("cnt"))).alias("comp"),
    )


@query(
    "w13_evidence_accumulation", views=["v_bronze"],
    sql=f"SELECT {_BSEL}, price, round(least(sum(greatest(disc - 0.04::DOUBLE, 0.0)) OVER ({_BW}) * 0.05::DOUBLE, 1.0), 6) AS buildup FROM v_bronze",
)
def _(t: Tables):
    s = W.evidence(t.bronze_series("disc"), F.col("disc"), 0.04, 0.05)
    return s.result().select(*_BID, "price", r6(F.col("buildup")).alias("buildup"))


@query(
    "w17_last_n_per_key",
    sql="SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20",
)
def _(t: Tables):
    return O.last_n(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 20).select("event_id", "user_id")


@query(
    "w19_decimate", views=["v_bronze"],
    sql=f"SELECT {_BSEL}, price FROM v_bronze QUALIFY (row_number() OVER ({_BW}) - 1) % 50 = 0",
)
def _(t: Tables):
    return W.decimate(t.bronze_series()).select(*_BID, "price")


# -- top-n --------------------------------------------------------------------------------


@query("t1_newest_rows", sql="SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def _(t: Tables):
    return O.tail(t.events, ["ts", "event_id"], 100).select("event_id", "value")


@query("t2_recent_history", sql="SELECT event_id, value FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)")
def _(t: Tables):
    return O.history(t.events, ["ts", "event_id"], 1000).select("event_id", "value")


@query(
    "t6_batch_caps",
    sql="SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 100",
)
def _(t: Tables):
    return O.first_n(t.events.select("event_type", "event_id", "ts"), ["event_type"], ["ts", "event_id"], 500 // 5).select("event_id", "event_type")


@query(
    "t8_latest_per_vehicle_module",
    sql="SELECT user_id, event_type, max_by(event_id, (ts, event_id)) AS event_id, max_by(value, (ts, event_id)) AS value FROM events GROUP BY ALL",
)
def _(t: Tables):
    df = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    return O.latest(df, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(
    "t9_recent_system_alerts",
    sql="""SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR AND event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 10""",
)
def _(t: Tables):
    recent = O.trailing(t.events.select("event_id", "ts", "event_type"), "ts", 7200)
    return O.tail(recent.filter("event_type = 'error'"), ["ts", "event_id"], 10).select("event_id", "ts")


# -- aggregates ---------------------------------------------------------------------------


@query("a1_row_counts", sql="SELECT user_id, count(*) AS rows FROM events GROUP BY ROLLUP (user_id)")
def _(t: Tables):
    return O.row_counts(t.events, ["user_id"])


@query(
    "a2_ingest_counters", views=["v_env"],
    sql="""SELECT module, count(*) AS attempted, count(*) FILTER (b NOT IN (1, 2, 3, 4, 5, 6, 7)) AS accepted,
        count(*) FILTER (b BETWEEN 1 AND 6) AS failed_validation, count(*) FILTER (b BETWEEN 1 AND 7) AS rejected FROM v_env GROUP BY module""",
)
def _(t: Tables):
    from motorpool.catalog.ingestqueries import CONTRACT
    from motorpool.operators.validate import with_row_error

    bad = F.col("error").isNotNull()
    outcome = F.when(bad, "invalid").when(F.col("row_hash") != F.concat(F.lit("h"), "event_id"), "duplicate").otherwise("accepted")
    checked = with_row_error(t.envelopes.select("event_id", "module", "data", "row_hash"), CONTRACT)
    return O.counters(checked.withColumn("outcome", outcome), "outcome", ["module"])


@query(
    "a3_latency_histogram",
    sql=f"""WITH {_LAT}, l AS (SELECT event_type, event_id % 2000 + 700 AS ms FROM lat), e(le) AS (VALUES {", ".join(f"('{x}')" for x in O.LATENCY_EDGES)}, ('+Inf'))
        SELECT event_type, le, count(*) FILTER (le = '+Inf' OR ms <= TRY_CAST(le AS BIGINT)) AS bucket, sum(ms)::BIGINT AS sum, count(*) AS count FROM l, e GROUP BY ALL""",
)
def _(t: Tables):
    df = latencies(t).select("event_type", timefmt.millis_between(F.col("ts"), F.col("inference")).alias("ms"))
    return O.histogram(df, ["event_type"], "ms")


_CARD = """card AS (SELECT coalesce(a.user_id, r.user_id) AS user_id, coalesce(n, 0) AS accepted, coalesce(rn, 0) AS rejected, lat, seen, ls, coalesce(n, 0) AS ln FROM
    (SELECT user_id, count(*) AS n, avg(event_id % 1000) AS lat, sum(event_id % 1000)::BIGINT AS ls, max(ts) AS seen FROM events WHERE event_id % 20 >= 8 OR event_id % 20 = 0 GROUP BY user_id) a
    FULL JOIN (SELECT user_id, count(*) AS rn FROM events WHERE event_id % 20 BETWEEN 1 AND 7 GROUP BY user_id) r ON a.user_id = r.user_id)"""
_NOW = "2024-02-01 00:00:00"


def _card(t: Tables):
    bad = (F.col("event_id") % 20).between(1, 7)
    df = t.events.select("user_id", "ts", "event_id", (F.col("event_id") % 1000).alias("ms"))
    return O.scorecard(df.filter(~bad), df.filter(bad), "user_id", "ts", "ms", F.lit(_NOW).cast("timestamp"))


@query(
    "a4_vehicle_scorecard",
    sql=f"""WITH {_CARD} SELECT user_id, accepted, rejected, printf('%.1f', accepted::DOUBLE / (accepted + rejected) * 100)::DOUBLE AS validation_rate,
        printf('%.1f', coalesce(lat, 0))::DOUBLE AS avg_latency_ms,
        printf('%.1f', (epoch_us(TIMESTAMP '{_NOW}') // 1000 - epoch_us(seen) // 1000) / 1000.0::DOUBLE)::DOUBLE AS seconds_since_seen FROM card""",
)
def _(t: Tables):
    return _card(t).drop("latency_sum", "latency_rows")


@query(
    "a5_fleet_totals",
    sql=f"""WITH {_CARD} SELECT sum(accepted)::BIGINT AS rows, count(*) FILTER (accepted > 0) AS active_vehicles,
        printf('%.1f', sum(ls)::DOUBLE / sum(ln))::DOUBLE AS avg_latency_ms, sum(rejected)::BIGINT AS dlq_backlog FROM card""",
)
def _(t: Tables):
    return O.fleet_totals(_card(t))


_ML = f"""{_LAT}, ml AS (SELECT event_type, avg(event_id % 2000 + 700) AS e, avg(CASE WHEN writer IS NULL THEN event_id % 2000 + 700 ELSE event_id % 2000 + 700 - event_id % 700 END) AS i, count(*) AS n FROM lat GROUP BY 1)"""


def _module_latency(t: Tables):
    c = F.col
    df = latencies(t).select(
        "event_type", timefmt.millis_between(c("ts"), c("inference")).alias("e2e"),
        timefmt.inference_latency_ms(c("ts"), c("writer"), c("inference")).alias("inf"),
    )
    return O.module_latency(df, "event_type", "e2e", "inf")


@query("a6_module_latency", sql=f"WITH {_ML} SELECT event_type, round(e, 4) AS avg_e2e_ms, round(i, 4) AS avg_inference_ms, n AS rows FROM ml")
def _(t: Tables):
    return _module_latency(t)[0].select("event_type", r4(F.col("avg_e2e_ms")).alias("avg_e2e_ms"), r4(F.col("avg_inference_ms")).alias("avg_inference_ms"), "rows")


@query("a6_fleet_latency", sql=f"WITH {_ML} SELECT round(avg(e), 4) AS avg_e2e_ms, round(avg(i), 4) AS avg_inference_ms, sum(n)::BIGINT AS rows FROM ml")
def _(t: Tables):
    return _module_latency(t)[1].select(r4(F.col("avg_e2e_ms")).alias("avg_e2e_ms"), r4(F.col("avg_inference_ms")).alias("avg_inference_ms"), "rows")


@query(
    "a7_distinct_active", views=["v_silver"],
    sql="""SELECT count(DISTINCT source_id) AS vehicles, count(DISTINCT module) AS modules, count(DISTINCT CASE WHEN severity = 'CRITICAL' THEN source_id END) AS alerting FROM v_silver""",
)
def _(t: Tables):
    # One pass of (vehicle, module) flags first, so the distinct counts see few rows.
    per = t.silver.groupBy("source_id", "module").agg(F.bool_or(F.col("severity") == "CRITICAL").alias("hit"))
    return per.agg(
        F.countDistinct("source_id").alias("vehicles"), F.countDistinct("module").alias("modules"),
        F.countDistinct(F.when(F.col("hit"), F.col("source_id"))).alias("alerting"),
    )


@query(
    "a8_feature_means", views=["v_bronze"],
    sql="SELECT module, feature, round(mean, 6) AS mean FROM (SELECT module, avg(qty) AS qty, avg(price) AS price, avg(disc) AS disc, avg(tax) AS tax FROM v_bronze GROUP BY module) UNPIVOT (mean FOR feature IN (qty, price, disc, tax))",
)
def _(t: Tables):
    cols = ["qty", "price", "disc", "tax"]
    means = t.bronze.groupBy("module").agg(*[F.avg(c).alias(c) for c in cols])
    return means.unpivot("module", cols, "feature", "mean").withColumn("mean", r6(F.col("mean")))


PROBS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p99_5": 0.995, "max": 1.0}


@query(
    "a9_calibration_percentiles", views=["v_bronze"],
    sql="SELECT module, " + ", ".join(f"round(quantile_cont(price, {p}), 6) AS {n}" for n, p in PROBS.items())
    + ", round(quantile_cont(price, 0.05), 6) AS p05, min(price) AS lowest FROM v_bronze GROUP BY module",
)
def _(t: Tables):
    q = exact_percentiles(t.bronze.select("module", "price"), ["module"], "price", {**PROBS, "p05": 0.05, "lowest": 0.0})
    return q.select("module", *[r6(F.col(c)).alias(c) for c in (*PROBS, "p05")], "lowest")


@query(
    "a10_legacy_calibration", views=["v_bronze"],
    sql="SELECT module, round(avg(price), 4) AS mean, round(stddev_pop(price), 4) AS std, min(price) AS lo, max(price) AS hi, round(avg(price) + 3 * stddev_pop(price), 4) AS threshold FROM v_bronze GROUP BY module",
)
def _(t: Tables):
    m, s = F.avg("price"), F.stddev_pop("price")
    return t.bronze.groupBy("module").agg(
        r4(m).alias("mean"), r4(s).alias("std"), F.min("price").alias("lo"), F.max("price").alias("hi"), r4(m + 3 * s).alias("threshold")
    )


@query("a11_noise_floor", views=["v_bronze"], sql="SELECT source_id, median(price) AS floor FROM v_bronze GROUP BY source_id")
def _(t: Tables):
    return exact_percentiles(t.bronze.select("source_id", "price"), ["source_id"], "price", {"floor": 0.5})


@query(
    "a16_severity_distribution", views=["v_silver"],
    sql="SELECT module, " + ", ".join(f"count(*) FILTER (severity = '{s}') AS {s}" for s in ("NORMAL", "WARNING", "CRITICAL")) + " FROM v_silver GROUP BY module",
)
def _(t: Tables):
    return t.silver.groupBy("module").pivot("severity", ["NORMAL", "WARNING", "CRITICAL"]).count().fillna(0)


_CUT = ("2024-01-12", "2024-01-20")


def _at(t: Tables, day: str, name: str, cond=None):
    df = t.silver.filter(F.col("ts") < F.lit(day).cast("timestamp"))
    df = df.filter(cond) if cond is not None else df
    return df.groupBy("module").agg(F.count("*").alias(name))


@query(
    "a21_layer_lags", views=["v_silver"],
    sql=f"""WITH c AS (SELECT module, count(*) FILTER (ts < '{_CUT[1]}') AS kafka, count(*) FILTER (ts < '{_CUT[0]}') AS bronze,
        count(*) FILTER (ts < '{_CUT[0]}' AND k > 20) AS silver, count(*) FILTER (ts < '{_CUT[0]}' AND k > 60) AS gold FROM v_silver GROUP BY module)
        SELECT module, greatest(kafka - bronze, 0) AS bronze_lag, greatest(silver - gold, 0) AS gold_lag, greatest(kafka - bronze, silver - gold, 0) AS worst FROM c""",
)
def _(t: Tables):
    k = F.col("k")
    return O.layer_lags(_at(t, _CUT[1], "n"), _at(t, _CUT[0], "n"), _at(t, _CUT[0], "n", k > 20), _at(t, _CUT[0], "n", k > 60))


@query("a21_alert_lag", sql="SELECT count(*) FILTER (ts > TIMESTAMP '2024-01-25 00:00:00') AS lag FROM events")
def _(t: Tables):
    from datetime import datetime, timezone

    return O.rows_after(t.events, "ts", datetime(2024, 1, 25, tzinfo=timezone.utc))


_WRITERS = """w AS (SELECT user_id AS module, CASE WHEN user_id % 3 = 0 THEN 'STOPPED' ELSE 'RUNNING' END AS status, count(*) AS total_rows, max(event_id) % 500 AS lag, count(*) * 10 AS duration_ms FROM events GROUP BY user_id)"""


def _writers(t: Tables):
    u = F.col("user_id")
    return t.events.groupBy(u.alias("module")).agg(
        F.count("*").alias("total_rows"), (F.max("event_id") % 500).alias("lag"), (F.count("*") * 10).alias("duration_ms")
    ).withColumn("status", F.when(F.col("module") % 3 == 0, "STOPPED").otherwise("RUNNING"))


@query(
    "a22_writer_summary",
    sql=f"""WITH {_WRITERS} SELECT count(*) FILTER (status = 'RUNNING') AS active, sum(total_rows)::BIGINT AS total_rows, sum(lag)::BIGINT AS total_lag,
        round(avg(duration_ms) FILTER (status = 'RUNNING'), 4) AS avg_duration_ms FROM w""",
)
def _(t: Tables):
    return O.writer_summary(_writers(t), running_only=True).withColumn("avg_duration_ms", r4(F.col("avg_duration_ms")))


@query(
    "a23_throughput", views=["v_silver"],
    sql=f"""WITH c AS (SELECT module, count(*) FILTER (ts < '{_CUT[0]}') AS i0, count(*) FILTER (ts < '{_CUT[1]}') AS i1,
        count(*) FILTER (ts < '{_CUT[0]}' AND k > 20) AS w0, count(*) FILTER (ts < '{_CUT[1]}' AND k > 20) AS w1 FROM v_silver GROUP BY module)
        SELECT coalesce(module, 'SUMMARY') AS name, sum(i1 - i0)::DOUBLE / 10 AS in_rate, sum(w1 - w0)::DOUBLE / 10 AS write_rate, sum(i1 - w1)::BIGINT AS backlog
        FROM c GROUP BY ROLLUP (module)""",
)
def _(t: Tables):
    snap = lambda d: _at(t, d, "incoming").join(_at(t, d, "written", F.col("k") > 20), "module", "left").fillna(0)
    return O.throughput(snap(_CUT[0]), snap(_CUT[1]), 10.0)


@query(
    "j7_module_status", views=["v_silver"],
    sql=f"""WITH k AS (SELECT module, count(*) AS offered FROM v_silver GROUP BY module), b AS (SELECT module, count(*) AS written FROM v_silver WHERE module <> 'tyre' AND ts < '{_CUT[1]}' GROUP BY module)
        SELECT k.module, offered, coalesce(written, 0) AS written, CASE WHEN k.module IN ('engine', 'body') THEN 'RUNNING' ELSE 'OFFLINE' END AS status, offered - coalesce(written, 0) AS lag FROM k LEFT JOIN b USING (module)""",
)
def _(t: Tables):
    listener = t.silver.filter(F.col("module").isin("engine", "body")).groupBy("module").agg(F.lit("RUNNING").alias("status"))
    return O.module_status(t.silver.groupBy("module").agg(F.count("*").alias("offered")), _at(t, _CUT[1], "written", F.col("module") != "tyre"), listener)


_GRID = """bins AS (SELECT vehicle, floor(t / 4)::BIGINT AS bin, avg(speed) AS speed FROM v_log GROUP BY ALL),
    grid AS (SELECT g.vehicle, g.bin, speed FROM (SELECT vehicle, unnest(range(min(bin), max(bin) + 1)) AS bin FROM bins GROUP BY vehicle) g LEFT JOIN bins USING (vehicle, bin))"""


@query("a24_resample_grid", views=["v_log"], sql=f"WITH {_GRID} SELECT vehicle, bin, round(speed, 6) AS speed FROM grid")
def _(t: Tables):
    s = W.resample(t.log.select("vehicle", "t", "speed"), ["vehicle"], "t", ["speed"], 4)
    return s.result().select("vehicle", "bin", r6(F.col("speed")).alias("speed"))


@query(
    "a25_complete_blocks", views=["v_log"],
    sql=f"""WITH bins AS (SELECT vehicle, floor(t / 30)::BIGINT AS bin, avg(speed) AS speed FROM v_log GROUP BY ALL),
        grid AS (SELECT g.vehicle, g.bin, speed FROM (SELECT vehicle, unnest(range(min(bin), max(bin) + 1)) AS bin FROM bins GROUP BY vehicle) g LEFT JOIN bins USING (vehicle, bin)),
        i AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY bin) - 1 AS i, count(*) OVER (PARTITION BY vehicle) AS n FROM grid)
        SELECT vehicle, i // 5 AS block, round(avg(speed), 6) AS speed_mean FROM i GROUP BY vehicle, i // 5, n HAVING count(*) = 5 AND count(speed) = 5 AND i // 5 * 5 < n - 5""",
)
def _(t: Tables):
    s = W.resample(t.log.select("vehicle", "t", "speed"), ["vehicle"], "t", ["speed"], 30)
    return W.complete_blocks(s, ["speed"], 5).withColumn("speed_mean", r6(F.col("speed_mean")))


@query(
    "a26_label_check",
    sql="""SELECT least(floor(v / 0.1) + 1, 10)::INT AS bin, count(*) AS n, round(avg(CASE WHEN v <= 0.9 THEN k END), 6) AS healthy_mean, round(avg(CASE WHEN v > 0.9 THEN k END), 6) AS faulty_mean
        FROM (SELECT ((event_id * 37) % 1000) / 1000.0::DOUBLE + 0.0005::DOUBLE AS v, value AS k FROM events) GROUP BY 1""",
)
def _(t: Tables):
    v = F.col("event_id") * 37 % 1000 / F.lit(1000.0) + 0.0005
    df = t.events.select(v.alias("v"), F.col("value").alias("k"))
    b = F.least(F.width_bucket("v", F.lit(0.0), F.lit(1.0), F.lit(10)), F.lit(10)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.count("*").alias("n"), r6(F.avg(F.when(F.col("v") <= 0.9, F.col("k")))).alias("healthy_mean"),
        r6(F.avg(F.when(F.col("v") > 0.9, F.col("k")))).alias("faulty_mean"),
    )


@query(
    "a27_dataset_metadata", views=["v_trips"],
    sql=" UNION ALL ".join(
        f"SELECT count(*) AS rows, max(trip) AS max_trip, '{c}' AS column, '{ty}' AS dtype, count(*) FILTER ({c} IS NULL) AS nulls FROM v_trips"
        for c, ty in (("vehicle", "string"), ("trip", "bigint"), ("speed", "bigint"), ("ax", "double"))
    ),
)
def _(t: Tables):
    return O.dataset_metadata(t.trip_series().result().select("vehicle", "trip", "speed", "ax"), "trip")


@query(
    "x14_trailing_window",
    sql="SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR GROUP BY 1",
)
def _(t: Tables):
    recent = O.trailing(t.events.select("event_type", "value", "ts"), "ts", 6 * 3600)
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"))



"""Health, alert, attribution and scalar scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.ingestqueries import _DTC, dtc_catalog
from motorpool.catalog.registry import Tables, query, r4, r6
from motorpool.functions import numeric, scoring, timefmt
from motorpool.operators.series import Series
from motorpool.plans import alerts as AL
from motorpool.plans import dtc as D
from motorpool.plans import health as H
from motorpool.plans import observe as O

_W = "make_timestamp(epoch_us(ts) // 300000000 * 300000000)"


def _gold_sql(modules=("engine", "transmission"), weights=(0.8, 0.2), penalties=(("engine", 20),)):
    picks = ", ".join(f"max_by(health, (ts, event_id)) FILTER (module = '{m}') AS {m}" for m in modules)
    mods = ", ".join(f"'{m}'" for m in modules)
    carry = ", ".join(f"coalesce(last_value({m} IGNORE NULLS) OVER w, 100.0::DOUBLE) AS {m}" for m in modules)
    total = " + ".join(f"{m} * {w}::DOUBLE" for m, w in zip(modules, weights))
    clamp = "total"
    for m, lim in penalties:
        clamp = f"CASE WHEN {m}_contrib < {lim} THEN least({clamp}, {m}_contrib) ELSE {clamp} END"
    contrib = ", ".join(f"printf('%.2f', {m})::DOUBLE AS {m}_contrib" for m in modules)
    return f"""win AS (SELECT source_id, {_W} AS window_ts, {picks} FROM v_silver WHERE module IN ({mods}) GROUP BY 1, 2),
        car AS (SELECT source_id, window_ts, {carry} FROM win WINDOW w AS (PARTITION BY source_id ORDER BY window_ts)),
        tot AS (SELECT *, 0.0::DOUBLE + {total} AS total, {contrib} FROM car),
        gold AS (SELECT source_id, window_ts AS gold_window_ts, total, printf('%.2f', {clamp})::DOUBLE AS vehicle_health_score,
          {clamp} < total AS penalised, {", ".join(f"{m}_contrib" for m in modules)} FROM tot)"""


def _gold(t: Tables):
    return H.gold_health(t.silver, now=F.lit("2026-01-01").cast("timestamp"))


@query(
    "a12_weighted_health_fusion", views=["v_silver"],
    sql=f"WITH {_gold_sql()} SELECT source_id, gold_window_ts, vehicle_health_score, engine_contrib, transmission_contrib FROM gold",
)
def _(t: Tables):
    return _gold(t).select("source_id", "gold_window_ts", "vehicle_health_score", "engine_contrib", "transmission_contrib")


@query(
    "a13_tier1_clamp", views=["v_silver"],
    sql=f"WITH {_gold_sql(penalties=(('engine', 50), ('transmission', 40)))} SELECT source_id, gold_window_ts, round(total, 6) AS raw_total, vehicle_health_score, penalised FROM gold",
)
def _(t: Tables):
    g = H.gold_health(t.silver, H.Fusion(penalties={"engine": 50.0, "transmission": 40.0}))
    return g.select("source_id", "gold_window_ts", r6(F.col("raw_total")).alias("raw_total"), "vehicle_health_score", "penalised")


@query(
    "a12_health_fusion_all_modules", views=["v_silver"],
    sql=f"""WITH {_gold_sql(tuple(H.FALLBACK_WEIGHTS), tuple(H.FALLBACK_WEIGHTS.values()), tuple(H.FALLBACK_PENALTIES.items()))}
        SELECT source_id, gold_window_ts, vehicle_health_score FROM gold""",
)
def _(t: Tables):
    g = H.gold_health(t.silver, H.Fusion(dict(H.FALLBACK_WEIGHTS), dict(H.FALLBACK_PENALTIES)))
    return g.select("source_id", "gold_window_ts", "vehicle_health_score")


@query(
    "w18_carry_forward", views=["v_silver"],
    sql=f"""SELECT source_id, window_ts, last_value(e IGNORE NULLS) OVER w AS engine_health, last_value(x IGNORE NULLS) OVER w AS transmission_health FROM (
        SELECT source_id, {_W} AS window_ts, max_by(health, (ts, event_id)) FILTER (module = 'engine') AS e,
        max_by(health, (ts, event_id)) FILTER (module = 'transmission') AS x FROM v_silver WHERE module IN ('engine', 'transmission') GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY source_id ORDER BY window_ts)""",
)
def _(t: Tables):
    mods = ("engine", "transmission")
    out = H.carried_windows(H.module_windows(t.silver, mods), mods)
    return out.select("source_id", "window_ts", *[F.col(f"{m}.health").alias(f"{m}_health") for m in mods])


@query(
    "x3_tumbling_window", views=["v_silver"],
    sql=f"SELECT source_id, {_W} AS window_ts, count(*) AS n, max(value) AS peak FROM v_silver GROUP BY 1, 2",
)
def _(t: Tables):
    w = F.window("ts", "300 seconds")["start"].alias("window_ts")
    return t.silver.groupBy("source_id", w).agg(F.count("*").alias("n"), F.max("value").alias("peak"))


@query(
    "t4_top5_weighted_features", views=["v_silver", "v_feat"],
    sql=f"""WITH win AS (SELECT source_id, {_W} AS window_ts, max_by(event_id, (ts, event_id)) FILTER (module = 'engine') AS engine,
          max_by(event_id, (ts, event_id)) FILTER (module = 'transmission') AS trans FROM v_silver WHERE module IN ('engine', 'transmission') GROUP BY 1, 2),
        car AS (SELECT source_id, window_ts, last_value(engine IGNORE NULLS) OVER w AS engine, last_value(trans IGNORE NULLS) OVER w AS trans
          FROM win WINDOW w AS (PARTITION BY source_id ORDER BY window_ts)),
        pool AS (SELECT c.source_id, window_ts, feature, val * 0.8::DOUBLE AS imp, 0 AS m, o FROM car c JOIN v_feat f ON f.event_id = c.engine
          UNION ALL SELECT c.source_id, window_ts, feature, val * 0.2::DOUBLE, 1, o FROM car c JOIN v_feat f ON f.event_id = c.trans),
        top AS (SELECT *, row_number() OVER (PARTITION BY source_id, window_ts ORDER BY imp DESC, m, o) AS r FROM pool QUALIFY r <= 5),
        kept AS (SELECT * FROM top QUALIFY r = max(r) OVER (PARTITION BY source_id, window_ts, feature))
        SELECT source_id, window_ts AS gold_window_ts, feature, printf('%.4f', imp)::DOUBLE AS impact FROM kept""",
)
def _(t: Tables):
    return _gold(t).select("source_id", "gold_window_ts", F.explode("top_5_features").alias("feature", "impact"))


@query(
    "a20_what_if_fusion", views=["v_silver"],
    sql=f"""WITH {_gold_sql()}, s AS (SELECT *, 0.0::DOUBLE + engine_contrib * 0.5::DOUBLE + transmission_contrib * 0.5::DOUBLE AS sim,
        least(CASE WHEN engine_contrib < 60 THEN engine_contrib ELSE 100 END, CASE WHEN transmission_contrib < 40 THEN transmission_contrib ELSE 100 END) AS pen FROM gold)
        SELECT source_id, gold_window_ts, printf('%.2f', CASE WHEN pen < 100 AND pen < sim THEN pen ELSE sim END)::DOUBLE AS simulated_health,
        pen < 100 AND pen < sim AS penalty_active FROM s""",
)
def _(t: Tables):
    g = H.what_if(_gold(t), {"engine": 0.5, "transmission": 0.5}, {"engine": 60.0, "transmission": 40.0})
    return g.select("source_id", "gold_window_ts", "simulated_health", "penalty_active")


@query(
    "a19_fleet_average_by_time", views=["v_silver"],
    sql=f"""WITH {_gold_sql()}, s AS (SELECT *, 0.0::DOUBLE + engine_contrib * 0.5::DOUBLE + transmission_contrib * 0.5::DOUBLE AS sim,
        CASE WHEN engine_contrib < 60 THEN engine_contrib ELSE 100 END AS pen FROM gold)
        SELECT gold_window_ts, round(avg(printf('%.2f', CASE WHEN pen < 100 AND pen < sim THEN pen ELSE sim END)::DOUBLE), 4) AS avg_health,
        bool_or(pen < 100 AND pen < sim) AS any_penalty, round(avg(engine_contrib), 4) AS engine_avg FROM s GROUP BY 1""",
)
def _(t: Tables):
    mods = {"engine": 0.5, "transmission": 0.5}
    out = H.fleet_by_time(H.what_if(_gold(t), mods, {"engine": 60.0}), mods)
    return out.select("gold_window_ts", r4(F.col("avg_health")).alias("avg_health"), "any_penalty", r4(F.col("engine_avg")).alias("engine_avg"))


@query(
    "w16_keep_last_per_window", views=["v_silver"],
    sql=f"SELECT source_id, {_W} AS gold_window_ts, max(event_id) AS event_id, max_by(health, event_id) AS health FROM v_silver GROUP BY 1, 2",
)
def _(t: Tables):
    writes = t.silver.select(
        "source_id", timefmt.floor_seconds(F.col("ts"), 300).alias("gold_window_ts"), F.col("event_id").alias("gold_write_ts"), "event_id", "health"
    )
    return H.last_per_window(writes).select("source_id", "gold_window_ts", "event_id", "health")


@query(
    "p16_weight_normalisation",
    sql="""SELECT user_id, event_type, round(w / s, 6) AS share, abs(s - 1) > 0.001 AS unbalanced, printf('%.3f', w / s)::DOUBLE AS rounded FROM (
        SELECT *, sum(w) OVER (PARTITION BY user_id) AS s FROM (SELECT user_id, event_type, count(*) / 128.0::DOUBLE AS w FROM events GROUP BY ALL))""",
)
def _(t: Tables):
    w = t.events.groupBy("user_id", "event_type").agg((F.count("*") / F.lit(128.0)).alias("w"))
    out = H.normalised_weights(w, "w", ["user_id"])
    return out.select("user_id", "event_type", r6(F.col("share")).alias("share"), "unbalanced", "rounded")


@query(
    "j2_weights_onto_silver", views=["v_silver"],
    sql="SELECT event_id, round(health * w, 6) AS weighted FROM v_silver JOIN (VALUES ('engine', 0.8::DOUBLE), ('transmission', 0.2::DOUBLE)) AS x(module, w) USING (module)",
)
def _(t: Tables):
    w = F.broadcast(t.spark.createDataFrame(list(H.Fusion().weights.items()), "module string, w double"))
    return t.silver.join(w, "module").select("event_id", r6(F.col("health") * F.col("w")).alias("weighted"))


# -- scalar scoring ----------------------------------------------------------------------

# Scoring limits of the engine model (fixed values).
LIMITS = {"p95": 1.4432270527, "p99_5": 5.6033077240, "top": 25.2039852142, "p05": -33.5683225596, "low": -163.0244000074}
_L = ", ".join(f"{v}::DOUBLE AS {k}" for k, v in LIMITS.items())
_SCORED = f"""lim AS (SELECT {_L}), a AS (SELECT event_id, source_id, module, ts, value / 20 AS e, -2.0::DOUBLE * k AS lp, lim.* FROM v_silver, lim),
    b AS (SELECT *, CASE WHEN lp >= p05 THEN 1.0::DOUBLE ELSE greatest(1 - abs(p05 - lp) / (abs(p05 - low) + 1e-6), 0.0) END AS fam,
      CASE WHEN e <= p95 THEN 0.5::DOUBLE * (e / p95) WHEN e <= p99_5 THEN 0.5::DOUBLE + 0.3::DOUBLE * ((e - p95) / (p99_5 - p95))
      ELSE 0.8::DOUBLE + 0.2::DOUBLE * least((e - p99_5) / (top - p99_5), 1.0) END AS risk FROM a),
    c AS (SELECT *, CASE WHEN fam > 0.8 AND risk < 0.9 THEN risk * 0.6::DOUBLE WHEN fam < 0.2 THEN least(risk + 0.2::DOUBLE, 1.0) ELSE risk END AS comp FROM b)"""


def scored_silver(t: Tables):
    lim = {k: F.lit(v) for k, v in LIMITS.items()}
    e, lp = F.col("value") / 20, -2.0 * F.col("k")
    fam = scoring.familiarity(lp, lim["p05"], lim["low"])
    risk = scoring.base_risk(e, lim["p95"], lim["p99_5"], lim["top"])
    df = t.silver.select("event_id", "source_id", "module", "ts", fam.alias("fam"), risk.alias("risk"))
    return df.withColumn("comp", scoring.regime_corrected(F.col("risk"), F.col("fam")))


@query("p10_familiarity", views=["v_silver"], sql=f"WITH {_SCORED} SELECT event_id, round(fam, 6) AS familiarity FROM c")
def _(t: Tables):
    return scored_silver(t).select("event_id", r6(F.col("fam")).alias("familiarity"))


@query("p11_composite_risk", views=["v_silver"], sql=f"WITH {_SCORED} SELECT event_id, round(risk, 6) AS risk, round(comp, 6) AS comp FROM c")
def _(t: Tables):
    return scored_silver(t).select("event_id", r6(F.col("risk")).alias("risk"), r6(F.col("comp")).alias("comp"))


@query(
    "p12_legacy_composite", views=["v_silver"],
    sql="""SELECT event_id, round(comp, 6) AS comp, CASE WHEN comp > 0.8 OR value > 150 THEN 'CRITICAL' WHEN comp > 0.5 THEN 'WARNING' ELSE 'NORMAL' END AS severity
        FROM (SELECT event_id, value, CASE WHEN k % 11 = 0 THEN least(norm + 0.3::DOUBLE, 1.0) ELSE norm END AS comp FROM (
        SELECT *, least(greatest((value - 5) / (195 + 1e-6::DOUBLE), 0.0), 1.0) AS norm FROM v_silver))""",
)
def _(t: Tables):
    comp = scoring.legacy_risk(F.col("value"), F.lit(5.0), F.lit(200.0), F.col("k") % 11 == 0)
    df = t.silver.select("event_id", "value", comp.alias("comp"))
    sev = scoring.legacy_severity(F.col("comp"), F.col("value"), F.lit(150.0))
    return df.select("event_id", r6(F.col("comp")).alias("comp"), sev.alias("severity"))


@query(
    "p13_health_and_code", views=["v_silver"],
    sql="SELECT event_id, round(health, 6) AS health, CASE severity WHEN 'NORMAL' THEN 0 WHEN 'WARNING' THEN 1 ELSE 2 END AS code FROM v_silver",
)
def _(t: Tables):
    return t.silver.select("event_id", r6(scoring.health(F.col("comp"))).alias("health"), scoring.severity_code(F.col("severity")).alias("code"))


@query(
    "p15_status_labels", views=["v_silver"],
    sql="""SELECT event_id, CASE WHEN k % 2 = 0 AND value > 10 THEN 'STALLED' WHEN k % 2 = 0 THEN 'RUNNING' ELSE 'STOPPED' END AS status,
        CASE WHEN value * 10 < 100 THEN 'healthy' WHEN value * 10 < 1000 THEN 'warning' ELSE 'critical' END AS lag_band,
        CASE WHEN value * 100 >= 5000 THEN 'LAGGING' ELSE 'HEALTHY' END AS system,
        CASE WHEN health >= 80 THEN 'good' WHEN health >= 50 THEN 'fair' ELSE 'poor' END AS band FROM v_silver""",
)
def _(t: Tables):
    v = F.col("value")
    status = F.when(F.col("k") % 2 == 0, "RUNNING").otherwise("STOPPED")
    return t.silver.select(
        "event_id", scoring.stream_status(status, v).alias("status"), scoring.lag_band(v * 10).alias("lag_band"),
        scoring.system_state(v * 100).alias("system"), scoring.health_band(F.col("health")).alias("band"),
    )


@query(
    "p9_feature_map_json", views=["v_feat"],
    sql="SELECT event_id, feature, round(val, 6) AS val FROM v_feat WHERE event_id % 10 <> 3",
)
def _(t: Tables):
    """Maps to JSON and back; every tenth text is cut off and therefore an empty map."""
    text = F.to_json("features")
    broken = F.when(F.col("event_id") % 10 == 3, F.expr("left(to_json(features), 4)")).otherwise(text)
    back = F.coalesce(F.from_json(F.col("j"), "map<string,double>"), F.create_map().cast("map<string,double>"))
    df = t.silver.select("event_id", broken.alias("j"))
    return df.select("event_id", F.explode(back).alias("feature", "val")).select("event_id", "feature", r6(F.col("val")).alias("val"))


@query(
    "t3_row_top_features", views=["v_feat"],
    sql="SELECT event_id, feature, round(val, 6) AS val FROM v_feat QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY val DESC, feature DESC) <= 2",
)
def _(t: Tables):
    return t.silver.select("event_id", F.explode(top_k(F.col("features"), 2)).alias("feature", "val")).select(
        "event_id", "feature", r6(F.col("val")).alias("val")
    )


def top_k(features, k: int):
    pairs = F.transform(F.map_entries(features), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k")))
    return F.map_from_entries(F.transform(F.slice(F.sort_array(pairs, asc=False), 1, k), lambda e: F.struct(e["k"], e["v"])))


@query(
    "p4_timestamp_parsing",
    sql="""SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL WHEN event_id % 5 IN (1, 2) THEN (epoch_us(ts) // 1000000 * 1000) WHEN event_id % 5 = 3 THEN (epoch_us(ts) // 1000000 * 1000) - 19800000 ELSE (epoch_us(ts) // 1000) END AS ms,
        CASE WHEN event_id % 5 = 4 THEN NULL WHEN event_id % 5 = 3 THEN strftime(ts - INTERVAL 19800 SECOND, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS utc FROM events""",
)
def _(t: Tables):
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+00:00'"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == 3, F.date_format("ts", "EEE MMM dd HH:mm:ss 'GMT+05:30' yyyy"))
        .otherwise(F.concat(F.lit("bad "), F.col("event_id")))
    )
    df = t.events.select("event_id", text.alias("s"))
    parsed = F.coalesce(timefmt.parse_iso(F.col("s")), timefmt.parse_device(F.col("s")))
    return df.select("event_id", F.unix_millis(parsed).alias("ms"), timefmt.utc_text(parsed).alias("utc"))


@query(
    "p5_numeric_coercion",
    sql="SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE user_id::VARCHAR END AS DOUBLE) AS num FROM events",
)
def _(t: Tables):
    text = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    return t.events.select("event_id", numeric.to_double(text).alias("num"))


_LAT = """lat AS (SELECT event_id, event_type, user_id, ts, ts + to_milliseconds(event_id % 900 - 100) AS broker,
    CASE WHEN event_id % 4 > 0 THEN ts + to_milliseconds(event_id % 700) END AS writer, ts + to_milliseconds(event_id % 2000 + 700) AS inference FROM events)"""


def latencies(t: Tables):
    i = F.col("event_id")
    plus = lambda ms: F.timestamp_micros(F.unix_micros("ts") + ms * 1000)
    return t.events.select(
        "event_id", "event_type", "user_id", "ts", plus(i % 900 - 100).alias("broker"), F.when(i % 4 > 0, plus(i % 700)).alias("writer"),
        plus(i % 2000 + 700).alias("inference"),
    )


@query(
    "p6_latencies",
    sql=f"""WITH {_LAT} SELECT event_id, CASE WHEN event_id % 900 >= 100 THEN event_id % 900 - 100 END AS broker_ms,
        greatest(1705708800000 - (epoch_us(ts) // 1000), 0) AS age_ms, (epoch_us(inference) // 1000) - (epoch_us(ts) // 1000) AS e2e_ms,
        CASE WHEN writer IS NULL THEN (epoch_us(inference) // 1000) - (epoch_us(ts) // 1000) ELSE (epoch_us(inference) // 1000) - (epoch_us(writer) // 1000) END AS inference_ms FROM lat""",
)
def _(t: Tables):
    c = F.col
    return latencies(t).select(
        "event_id", timefmt.broker_latency_ms(c("ts"), c("broker")).alias("broker_ms"),
        timefmt.age_ms(c("ts"), F.lit("2024-01-20").cast("timestamp")).alias("age_ms"),
        timefmt.millis_between(c("ts"), c("inference")).alias("e2e_ms"),
        timefmt.inference_latency_ms(c("ts"), c("writer"), c("inference")).alias("inference_ms"),
    )


@query(
    "p7_sanitise",
    sql="""SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN 0.0::DOUBLE WHEN event_id % 4 = 2 THEN 0.0 ELSE value END AS v,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CASE WHEN event_id % 2 = 0 THEN 0 ELSE user_id END AS u FROM events""",
)
def _(t: Tables):
    i = F.col("event_id")
    v = F.when(i % 4 == 0, float("nan")).when(i % 4 == 1, float("inf")).when(i % 4 == 2, None).otherwise(F.col("value"))
    df = t.events.select("event_id", v.alias("v"), "ts", F.when(i % 2 == 1, F.col("user_id")).alias("u"))
    return numeric.sanitise(df)


@query(
    "p8_scaling", views=["v_bronze"],
    sql="""SELECT source_id, okey, line, pkey, round((qty - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS z, round((qty - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 6) AS unit
        FROM v_bronze JOIN (SELECT module, avg(qty) AS m, stddev_pop(qty) AS s, min(qty) AS lo, max(qty) AS hi FROM v_bronze GROUP BY module) USING (module)""",
)
def _(t: Tables):
    b = t.bronze.select("source_id", "module", "okey", "line", "pkey", "qty")
    stats = b.groupBy("module").agg(F.avg("qty").alias("m"), F.stddev_pop("qty").alias("s"), F.min("qty").alias("lo"), F.max("qty").alias("hi"))
    # One row per module of the contract.
    j = b.join(F.broadcast(stats), "module")
    q = F.col("qty")
    return j.select(
        "source_id", "okey", "line", "pkey", r6(numeric.standard_scale(q, F.col("m"), F.col("s"))).alias("z"),
        r6(numeric.minmax_scale(q, F.col("lo"), F.col("hi"))).alias("unit"),
    )


@query(
    "p17_time_slice",
    sql="SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'",
)
def _(t: Tables):
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    raw = t.table("events").filter(F.col("ts").between(lit("2024-01-05 00:00:00"), lit("2024-01-09 12:00:00")))
    return raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"))


@query(
    "p18_unpivot_codes", views=["v_bronze"],
    sql="SELECT source_id, okey, line, pkey, code, p FROM (SELECT source_id, okey, line, pkey, disc, tax FROM v_bronze) UNPIVOT (p FOR code IN (disc, tax))",
)
def _(t: Tables):
    b = t.bronze.select("source_id", "okey", "line", "pkey", "disc", "tax")
    return D.long_codes(b, ["source_id", "okey", "line", "pkey"], ["disc", "tax"])


@query(
    "p23_metrics_exposition",
    sql="SELECT 'telemetry_rows_total' AS metric, 'sim' || user_id AS vehicle, event_type AS module, count(*)::DOUBLE AS reading FROM events GROUP BY user_id, event_type",
)
def _(t: Tables):
    per = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    line = F.format_string('telemetry_rows_total{vehicle="sim%d",module="%s"} %d', "user_id", "event_type", "n")
    text = per.select(F.explode(F.array(line, F.lit("# HELP rows"))).alias("value"))
    return O.exposition(text)


# -- alerts -------------------------------------------------------------------------------

_DELTA = "CASE severity WHEN 'CRITICAL' THEN 20 WHEN 'WARNING' THEN 5 WHEN 'NORMAL' THEN -10 ELSE 0 END"
_FSM = f"""f AS MATERIALIZED (SELECT source_id, rn, ts, comp, severity, {_DELTA} AS d, price, disc, tax FROM v_fault),
    s AS (SELECT source_id, rn, ts, comp, d, greatest(0, least(100, d)) AS score FROM f WHERE rn = 1
      UNION ALL SELECT f.source_id, f.rn, f.ts, f.comp, f.d, greatest(0, least(100, s.score + f.d)) FROM s JOIN f ON f.source_id = s.source_id AND f.rn = s.rn + 1),
    x AS (SELECT s.*, coalesce(sum((score = 0)::INT) OVER (PARTITION BY source_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS excursion FROM s),
    al AS (SELECT source_id, excursion, CASE WHEN min(score) = 0 THEN 'CLOSED' ELSE 'OPEN' END AS status, min(ts) FILTER (score > 0) AS alert_start_ts,
      max(ts) FILTER (score = 0) AS alert_end_ts, arg_min(ts, (-comp, rn)) FILTER (score > 0 AND comp > 0) AS peak_anomaly_ts,
      printf('%.4f', max(comp) FILTER (score > 0))::DOUBLE AS max_composite_score FROM x GROUP BY ALL HAVING max(score) = 100)"""
_ALERT_COLS = ("source_id", "status", "alert_start_ts", "alert_end_ts", "peak_anomaly_ts", "max_composite_score")


def fault_series(t: Tables, *extra) -> Series:
    df = t.fault.select("source_id", *t.BRONZE_ORDER, "severity", "comp", *extra)
    return Series(df, ["source_id"], t.BRONZE_ORDER)


@query("x5_alert_episodes", views=["v_fault"], recursive=True, sql=f"WITH {_FSM} SELECT {', '.join(_ALERT_COLS)} FROM al")
def _(t: Tables):
    return AL.episodes(fault_series(t)).select(*_ALERT_COLS)


@query("f3_episode_table_function", views=["v_fault"], recursive=True, sql=f"WITH {_FSM} SELECT {', '.join(_ALERT_COLS)} FROM al")
def _(t: Tables):
    return AL.episodes_by_fold(fault_series(t)).select(*_ALERT_COLS)


@query("f2_ordered_fold", views=["v_fault"], recursive=True, sql=f"WITH {_FSM} SELECT source_id, ts, rn, score::DOUBLE AS score FROM s")
def _(t: Tables):
    s = AL.scored(fault_series(t)).indexed("rn")
    return s.result().select("source_id", "ts", (F.col("rn") + 1).alias("rn"), "score")


def _fault_feats(t: Tables):
    feats = F.to_json(F.struct((F.col("price") / 100).alias("price"), F.col("disc"), F.col("tax")))
    df = t.fault.select("source_id", *t.BRONZE_ORDER, "severity", "comp", feats.alias("top_features"))
    return Series(df, ["source_id"], t.BRONZE_ORDER)


_FEATSUM = f"""WITH {_FSM}, e AS (SELECT x.source_id, x.excursion, unnest(['price', 'disc', 'tax']) AS feature, unnest([f.price / 100, f.disc, f.tax]) AS v
    FROM x JOIN f USING (source_id, rn) JOIN al USING (source_id, excursion) WHERE score > 0)"""


@query(
    "a14_fault_feature_sums", views=["v_fault"], recursive=True,
    sql=f"{_FEATSUM} SELECT source_id, excursion, feature, round(sum(v), 4) AS total FROM e GROUP BY ALL",
)
def _(t: Tables):
    s = AL.excursions(_fault_feats(t))
    sums = AL.feature_sums(s.result().filter("score > 0"), ["source_id", "excursion"], "top_features")
    hit = s.df.groupBy("source_id", "excursion").agg(F.max("score").alias("m")).filter("m >= 100").drop("m")
    return sums.join(hit, ["source_id", "excursion"], "left_semi").select("source_id", "excursion", "feature", r4(F.col("total")).alias("total"))


@query(
    "t5_top_features_per_alert", views=["v_fault"], recursive=True,
    sql=f"{_FEATSUM} SELECT source_id, alert_start_ts, feature, round(sum(v), 4) AS total FROM e JOIN al USING (source_id, excursion) GROUP BY source_id, excursion, alert_start_ts, feature",
)
def _(t: Tables):
    al = AL.episodes(_fault_feats(t), "top_features")
    return al.select("source_id", "alert_start_ts", F.explode("top_10_features").alias("feature", "total"))


@query(
    "a15_true_alert_matrix", views=["v_fault"], recursive=True,
    sql=f"""WITH {_FSM}, p AS (SELECT source_id::VARCHAR AS vehicle, count(*) FILTER (m = 0) AS m0, count(*) FILTER (m = 1) AS m1, count(*) FILTER (m = 2) AS m2, count(*) AS total
        FROM (SELECT source_id, excursion % 3 AS m FROM al) GROUP BY source_id)
        SELECT * FROM p UNION ALL SELECT 'TOTAL_BY_MODULE', sum(m0)::BIGINT, sum(m1)::BIGINT, sum(m2)::BIGINT, sum(total)::BIGINT FROM p""",
)
def _(t: Tables):
    al = AL.episodes(fault_series(t)).withColumn("module", F.concat(F.lit("m"), F.col("excursion") % 3))
    return AL.alert_matrix(al, "source_id", "module", ["m0", "m1", "m2"])


@query(
    "t7_open_and_closed_alerts", views=["v_fault"], recursive=True,
    sql=f"""WITH {_FSM} SELECT source_id, status, coalesce(alert_end_ts, peak_anomaly_ts) AS sort_ts FROM al""",
)
def _(t: Tables):
    opened, closed = AL.live_split(AL.episodes(fault_series(t)))
    return opened.select("source_id", "status", F.col("peak_anomaly_ts").alias("sort_ts")).union(
        closed.select("source_id", "status", F.col("alert_end_ts").alias("sort_ts"))
    )


@query(
    "x11_one_payload_per_alert", views=["v_fault"], recursive=True,
    sql=f"""WITH {_FSM}, p AS (SELECT x.source_id, x.excursion, x.score, x.ts, row_number() OVER (PARTITION BY x.source_id, x.excursion ORDER BY rn DESC) AS r
        FROM x JOIN al USING (source_id, excursion)) SELECT source_id, excursion, ts AS last_ts, score::DOUBLE AS last_score FROM p WHERE r = 1""",
)
def _(t: Tables):
    s = AL.excursions(fault_series(t))
    per = s.df.groupBy("source_id", "excursion").agg(
        F.max("score").alias("top"), F.max_by(F.struct("ts", "score"), F.struct(*s.order)).alias("p")
    )
    return per.filter("top >= 100").select("source_id", "excursion", F.col("p.ts").alias("last_ts"), F.col("p.score").alias("last_score"))


# -- drill-down ---------------------------------------------------------------------------

_TRACE = """tr AS (SELECT a.source_id, a.excursion, b.ts, b.okey, b.line, b.pkey, b.price, b.qty, b.disc, b.tax,
    row_number() OVER (PARTITION BY a.source_id, a.excursion ORDER BY b.ts DESC, b.okey DESC, b.line DESC, b.pkey DESC, b.price DESC) AS back
    FROM al a JOIN v_bronze b ON b.source_id = a.source_id AND b.ts <= a.peak_anomaly_ts QUALIFY back <= 50)"""


def _slices(t: Tables, rows: int = 50):
    al = AL.episodes(fault_series(t)).withColumn("alert", F.concat_ws("-", "source_id", "excursion"))
    return AL.traceback(al, t.bronze, "source_id", "alert", "peak_anomaly_ts", list(t.BRONZE_ORDER), rows)


@query(
    "j3_alert_traceback", views=["v_fault"], recursive=True,
    sql=f"WITH {_FSM}, {_TRACE} SELECT source_id || '-' || excursion AS alert, okey, line, pkey, price, qty FROM tr",
)
def _(t: Tables):
    return _slices(t).select("alert", "okey", "line", "pkey", "price", "qty")


@query(
    "j3_alert_traceback_default_depth", views=["v_fault"], recursive=True,
    sql=f"""WITH {_FSM}, {_TRACE.replace('<= 50', '<= 600')} SELECT source_id || '-' || excursion AS alert, count(*) AS n, sum(okey)::BIGINT AS keys FROM tr GROUP BY ALL""",
)
def _(t: Tables):
    return _slices(t, AL.LOOKBACK_ROWS).groupBy("alert").agg(F.count("*").alias("n"), F.sum("okey").alias("keys"))


MODELS = [
    {"code": "P00", "features": ["qty", "disc"], "lo": [1, 0], "hi": [50, 0.1], "coef": [4.0, 1.0], "intercept": -3.0},
    {"code": "P01", "features": ["tax", "qty"], "lo": [0, 1], "hi": [0.08, 50], "coef": [5.0, -1.0], "intercept": -2.0},
    {"code": "P02", "features": ["price", "disc"], "lo": [900, 0], "hi": [105000, 0.1], "coef": [3.0, 2.0], "intercept": -2.5},
    {"code": "P03", "features": ["absent"], "lo": [0], "hi": [1], "coef": [1.0], "intercept": 0.0},
]


def _z(m):
    terms = "".join(f" + {float(b)}::DOUBLE * ({f} - {float(lo)}::DOUBLE) / {float(hi - lo)}::DOUBLE" for f, lo, hi, b in zip(m["features"], m["lo"], m["hi"], m["coef"]))
    return f"1 / (1 + exp(-({float(m['intercept'])}::DOUBLE{terms}))) AS {m['code']}"


_PROBS = ", ".join(_z(m) for m in MODELS[:3])


@query(
    "m7_code_scoring", views=["v_bronze"],
    sql=f"SELECT source_id, okey, line, pkey, round(P00, 6) AS P00, round(P01, 6) AS P01, round(P02, 6) AS P02 FROM (SELECT *, {_PROBS} FROM v_bronze)",
)
def _(t: Tables):
    df = D.score_codes(t.bronze, MODELS)
    return df.select("source_id", "okey", "line", "pkey", *[r6(F.col(c)).alias(c) for c in ("P00", "P01", "P02")])


_ATTR = f"""{_TRACE}, pr AS (SELECT *, source_id || '-' || excursion AS alert, {_PROBS} FROM tr), lg AS (SELECT alert, back, code, p FROM
    (SELECT alert, back, P00, P01, P02 FROM pr) UNPIVOT (p FOR code IN (P00, P01, P02))),
    ev AS (SELECT *, power(greatest(p - median(p) OVER (PARTITION BY alert, code), 0.0), 2) AS e FROM lg),
    bu AS (SELECT *, sum(e) OVER (PARTITION BY alert, code ORDER BY back DESC) AS b FROM ev),
    att AS (SELECT *, least(b * CASE WHEN g > 1e-6 THEN 1 / g ELSE 0.0 END, 1.0) AS risk FROM (SELECT *, max(b) OVER (PARTITION BY alert) AS g FROM bu))"""


def _attributed(t: Tables):
    scored = D.score_codes(_slices(t), MODELS)
    return D.attribute(D.long_codes(scored, ["alert", "pos"], ["P00", "P01", "P02"]), "alert")


@query(
    "w14_smart_attribution", views=["v_fault"], recursive=True,
    sql=f"WITH {_FSM}, {_ATTR} SELECT alert, code, count(*) AS n, round(sum(risk), 4) AS area, round(max(risk), 6) AS peak FROM att GROUP BY ALL",
)
def _(t: Tables):
    return _attributed(t).groupBy("alert", "code").agg(
        F.count("*").alias("n"), r4(F.sum("risk")).alias("area"), r6(F.max("risk")).alias("peak")
    )


@query(
    "m8_code_triggers", views=["v_fault"], recursive=True,
    sql=f"""WITH {_FSM}, {_ATTR}, {_DTC} SELECT t.alert, t.code, CASE WHEN coalesce(d.severity, 'critical') = 'critical' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
        coalesce(d.message, 'Unknown Critical Error') AS message FROM (SELECT alert, code FROM att GROUP BY ALL HAVING max(risk) >= 0.99) t LEFT JOIN dtc d ON d.dtc_code = t.code AND d.module = 'engine'""",
)
def _(t: Tables):
    return D.triggers(_attributed(t), dtc_catalog(t), "alert", "engine")


@query(
    "j1_code_messages",
    sql=f"""WITH {_DTC}, c AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'tyre' ELSE 'engine' END AS module, 'P' || (event_id % 6) || (event_id % 5) AS code FROM events)
        SELECT event_id, code, coalesce(message, CASE WHEN coalesce(severity, 'critical') = 'critical' THEN 'Unknown Critical Error' END) AS message
        FROM c LEFT JOIN dtc ON dtc_code = code AND dtc.module = c.module""",
)
def _(t: Tables):
    module = F.when(F.col("event_id") % 3 == 0, "tyre").otherwise("engine")
    codes = t.events.select("event_id", module.alias("module"), F.concat(F.lit("P"), F.col("event_id") % 6, F.col("event_id") % 5).alias("code"))
    return D.with_messages(codes, dtc_catalog(t)).select("event_id", "code", "message")


@query(
    "w15_global_magnify", views=["v_bronze"],
    sql="""WITH l AS (SELECT source_id, okey, line, pkey, code, p FROM (SELECT source_id, okey, line, pkey, disc, tax FROM v_bronze) UNPIVOT (p FOR code IN (disc, tax)))
        SELECT source_id, okey, line, pkey, code, round((p - lo) / (hi - lo), 6) AS p FROM l, (SELECT min(p) AS lo, max(p) AS hi FROM l)""",
)
def _(t: Tables):
    b = t.bronze.select("source_id", "okey", "line", "pkey", "disc", "tax")
    out = D.magnify(D.long_codes(b, ["source_id", "okey", "line", "pkey"], ["disc", "tax"]))
    return out.withColumn("p", r6(F.col("p")))



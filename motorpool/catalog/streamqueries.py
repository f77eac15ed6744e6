"""Streaming queries: each drains the data now available and returns what a reader sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.goldqueries import _ALERT_COLS, _FSM, _gold_sql
from motorpool.catalog.ingestqueries import CONTRACT
from motorpool.catalog.registry import MODULE_OF, Tables, envelope_view, query, r6, silver_view
from motorpool.catalog.windowqueries import _ema_sql
from motorpool.functions.numeric import round_py
from motorpool.operators.validate import with_row_error
from motorpool.plans import health as H
from motorpool.plans import observe as O
from motorpool.session import scratch_path
from motorpool.sources.files import explode_metrics
from motorpool.sources.streams import append_sink, drain, file_source
from motorpool.sources.tables import UpsertTable
from motorpool.streaming import dedup as DD
from motorpool.streaming import processors as P
from motorpool.streaming import run as R
from motorpool.streaming import sinks as S
from motorpool.streaming import stateful as ST


def stream_of(t: Tables, name: str, **options):
    src = file_source(t.spark, t.dir, t.table(name).schema, glob=f"{name}.parquet", **options)
    return src.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else src


def _thirds(df):
    """The rows of three thirds of the month, in order."""
    return [df.filter(F.floor(F.dayofmonth("ts") / 11) == part) for part in (0, 1, 2)]


@query("x1_stream_dedup", views=["v_env"], sql="SELECT DISTINCT row_hash FROM v_env")
def _(t: Tables):
    env = envelope_view(stream_of(t, "events")).select("row_hash", "ts")
    return drain(DD.dedup(env, ts="ts").select("row_hash"), "x1")


@query("x1_stream_dedup_unbounded", views=["v_env"], sql="SELECT DISTINCT row_hash FROM v_env")
def _(t: Tables):
    env = envelope_view(stream_of(t, "events")).select("row_hash", "ts")
    return drain(DD.dedup(env, within=None).select("row_hash"), "x1u")


@query("x1_late_first_occurrences", views=["v_env"], sql="SELECT DISTINCT row_hash FROM v_env")
def _(t: Tables):
    """Three micro-batches, the oldest rows in the last one: late keys come out all the same."""
    base = scratch_path(t.spark, "x1late")
    env = t.envelopes.select("row_hash", "ts")
    R.in_steps(t.spark, _thirds(env)[::-1], f"{base}/in", lambda src: DD.dedup_sink(src, f"{base}/out", f"{base}/state", ts="ts"))
    return t.spark.read.schema(env.schema).parquet(f"{base}/out/v*").select("row_hash")


@query(
    "x2_ttl_return",
    sql="SELECT event_id * 4 + c AS copy, c IN (0, 2) AS accepted FROM events, (VALUES (0), (1), (2), (3)) AS v(c)",
)
def _(t: Tables):
    """Every event again after 20, 70 and 100 minutes: the hour makes the second one a repeat, the third is new, the fourth repeats it."""
    copies = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(m).alias("m")) for c, m in enumerate((0, 20, 70, 100))]))
    rows = t.events.select("event_id", "ts", copies.alias("x")).select(
        F.concat(F.lit("h"), "event_id").alias("row_hash"), (F.col("event_id") * 4 + F.col("x.c")).alias("copy"),
        F.timestamp_seconds(F.unix_timestamp("ts") + F.col("x.m") * 60).alias("ts"),
    )
    base = scratch_path(t.spark, "x2ttl")
    rows.write.parquet(f"{base}/in")
    return drain(DD.outcomes(file_source(t.spark, f"{base}/in", rows.schema), "row_hash", "ts", "copy", 3600), "x2").select("copy", "accepted")


@query(
    "x2_ttl_idempotency", views=["v_env"],
    sql="SELECT row_hash, count(*) AS seen, 1::BIGINT AS accepted, count(*) - 1 AS duplicates FROM v_env GROUP BY row_hash",
)
def _(t: Tables):
    """Accepted rows come from the state store with a one-hour TTL; the rest are reported as duplicates."""
    env = envelope_view(stream_of(t, "events")).select("row_hash", "ts", "event_id")
    accepted = drain(DD.dedup(env, ts="ts", within="1 hour").select("row_hash"), "x2").groupBy("row_hash").agg(F.count("*").alias("accepted"))
    seen = t.envelopes.groupBy("row_hash").agg(F.count("*").alias("seen"))
    return seen.join(accepted, "row_hash", "left").select(
        "row_hash", "seen", "accepted", (F.col("seen") - F.col("accepted")).alias("duplicates")
    )


@query(
    "x3_stream_tumbling_window", views=["v_silver"],
    sql="""WITH w AS (SELECT module, make_timestamp(epoch_us(ts) // 300000000 * 300000000) AS window_ts, count(*) AS n, max(value) AS peak FROM v_silver GROUP BY 1, 2)
        SELECT * FROM w WHERE window_ts + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM v_silver)""",
)
def _(t: Tables):
    """Append mode: windows are final once the watermark has passed them."""
    s = silver_view(stream_of(t, "events")).withWatermark("ts", "10 minutes")
    agg = s.groupBy("module", F.window("ts", "300 seconds")).agg(F.count("*").alias("n"), F.max("value").alias("peak"))
    return drain(agg.select("module", F.col("window.start").alias("window_ts"), "n", "peak"), "x3")


@query(
    "x4_stream_health_windows", views=["v_silver"],
    sql=f"WITH {_gold_sql()} SELECT source_id, gold_window_ts, vehicle_health_score, engine_contrib, transmission_contrib FROM gold",
)
def _(t: Tables):
    out = drain(ST.health_windows(silver_view(stream_of(t, "events"))), "x4")
    kept = ST.latest_payloads(out, ["source_id", "gold_window_ts"])
    return kept.select("source_id", "gold_window_ts", "vehicle_health_score", "engine_contrib", "transmission_contrib")


def fault_stream(t: Tables):
    """The fault view as a stream; ``event_id`` numbers rows in the batch order."""
    q = F.col("l_quantity")
    sev = F.when(q >= 38, "CRITICAL").when(q >= 28, "WARNING").otherwise("NORMAL")
    # (order, line, part) as one sortable number.
    num = F.col("l_orderkey") * 100_000_000_000 + F.col("l_linenumber") * 10_000_000_000 + F.col("l_partkey")
    return stream_of(t, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("source_id"), F.lit("fleet").alias("module"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        num.alias("event_id"), sev.alias("severity"), (q / 50.0).alias("comp"),
        F.to_json(F.struct(F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"))).alias("top_features"),
    )


@query(
    "x5_stream_alerts", views=["v_fault"], recursive=True,
    sql=f"WITH {_FSM} SELECT {', '.join('source_id::VARCHAR AS source_id' if c == 'source_id' else c for c in _ALERT_COLS)} FROM al",
)
def _(t: Tables):
    """Alert stream upserted by ``alert_id``."""
    base = scratch_path(t.spark, "x5")
    table = UpsertTable(t.spark, f"{base}/alerts", ["alert_id"])
    R.upsert_sink(ST.alerts(fault_stream(t)), table, f"{base}/state").awaitTermination()
    return table.read().select(*_ALERT_COLS)


@query("x6_stream_smoothing", views=["v_silver"], recursive=True, sql=_ema_sql("0.2::DOUBLE * x"))
def _(t: Tables):
    s = silver_view(stream_of(t, "events")).withColumn("error", F.col("value")).withColumn("risk", F.col("comp"))
    return drain(ST.smooth(s), "x6").select("event_id", r6(F.col("ema")).alias("ema"))


@query("x7_resume_from_checkpoint", sql="SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def _(t: Tables):
    """Two runs over a growing folder with one checkpoint: nothing lost, nothing twice."""
    base = scratch_path(t.spark, "x7")
    rows = t.events.select("event_id", "event_type")
    schema = rows.schema
    for part in (0, 1):
        rows.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        src = file_source(t.spark, f"{base}/in", schema)
        append_sink(src, f"{base}/out", f"{base}/state", f"x7-{part}-{base[-6:]}", trigger={"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("x8_capped_micro_batches", sql="SELECT user_id % 4 AS part, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    """One file per micro-batch; the number of batches shows in the output versions."""
    base = scratch_path(t.spark, "x8")
    rows = t.events.select((F.col("user_id") % 4).alias("part"), "event_id")
    rows.repartition(4, "event_id").write.parquet(f"{base}/in")
    src = file_source(t.spark, f"{base}/in", rows.schema, max_files=1)
    append_sink(src, f"{base}/out", f"{base}/state", f"x8-{base[-6:]}", trigger={"availableNow": True}).awaitTermination()
    return t.spark.read.parquet(f"{base}/out").groupBy("part").agg(F.count("*").alias("n"))


@query("x9_progress_metrics", sql="SELECT 'STOPPED' AS state, count(*) AS total_rows, 0::BIGINT AS backlog FROM events")
def _(t: Tables):
    listener = R.ProgressMetrics()
    base = scratch_path(t.spark, "x9")
    name = f"x9-{base[-6:]}"
    t.spark.streams.addListener(listener)
    try:
        q = append_sink(stream_of(t, "events").select("event_id"), f"{base}/out", f"{base}/state", name, trigger={"availableNow": True})
        q.awaitTermination()
        _await(lambda: listener.streams.get(name, {}).get("total_rows") and listener.streams[name]["status"] == "STOPPED")
    finally:
        t.spark.streams.removeListener(listener)
    doc = t.spark.createDataFrame([(listener.document(),)], "value string")
    return explode_metrics(doc).select(F.col("status").alias("state"), "total_rows", "backlog")


def _await(ready, seconds: float = 20.0):
    import time

    end = time.time() + seconds
    while time.time() < end and not ready():
        time.sleep(0.1)


@query(
    "x10_late_rows_restated", views=["v_silver"],
    sql=f"WITH {_gold_sql()} SELECT source_id, gold_window_ts, vehicle_health_score FROM gold",
)
def _(t: Tables):
    """Every ninth row arrives late: its vehicle is rewritten from that window on, readers keep the last write."""
    late = F.col("event_id") % 9 == 0
    mods = list(H.Fusion().weights)
    base = t.silver.filter(F.col("module").isin(*mods))
    first = H.gold_health(base.filter(~late), now=F.lit("2026-01-01 00:00:00").cast("timestamp"))
    full = H.gold_health(base, now=F.lit("2026-01-01 00:05:00").cast("timestamp"))
    again = ST.restated(base.filter(late), full.withColumn("ts", F.col("gold_window_ts"))).drop("ts")
    kept = H.last_per_window(first.unionByName(again).select("source_id", "gold_window_ts", "vehicle_health_score", "gold_write_ts"))
    return kept.select("source_id", "gold_window_ts", "vehicle_health_score")


@query(
    "x11_upsert_after_reset",
    sql="SELECT user_id, max(event_id) AS event_id, 'second' AS run FROM events WHERE event_id % 2 = 1 GROUP BY user_id UNION ALL "
        "SELECT user_id, max(event_id), 'first' FROM events WHERE event_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 1) GROUP BY user_id",
)
def _(t: Tables):
    """A second run after the checkpoint was set aside starts at batch 0 again; its updates win, the others stay."""
    base = scratch_path(t.spark, "x11")
    table = UpsertTable(t.spark, f"{base}/table", ["user_id"])
    for rest, run in ((0, "first"), (1, "second")):
        rows = t.events.filter(F.col("event_id") % 2 == rest).select("user_id", "event_id", F.lit(run).alias("run"))
        rows.write.parquet(f"{base}/in-{run}")
        R.upsert_sink(file_source(t.spark, f"{base}/in-{run}", rows.schema), table, f"{base}/state", order="event_id").awaitTermination()
        R.archive_checkpoint(t.spark, f"{base}/state")
    return table.read()


@query("x12_query_per_module", views=["v_silver"], sql="SELECT module, count(*) AS n FROM v_silver GROUP BY module")
def _(t: Tables):
    base = scratch_path(t.spark, "x12")

    def start(module):
        R.in_pool(t.spark, module)
        rows = silver_view(stream_of(t, "events")).filter(F.col("module") == module).select("event_id", "module")
        return append_sink(rows, f"{base}/{module}", f"{base}/state/{module}", f"x12-{module}-{base[-6:]}", trigger={"availableNow": True})

    running, failed = R.per_module(list(MODULE_OF.values()), start)
    R.in_pool(t.spark, None)
    if failed:
        raise RuntimeError(f"modules that did not start: {failed}")
    for q in running.values():
        q.awaitTermination()
    out = None
    for m in MODULE_OF.values():
        part = t.spark.read.schema("event_id bigint, module string").parquet(f"{base}/{m}")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("module").agg(F.count("*").alias("n"))


@query(
    "x13_observer_snapshot", views=["v_silver"],
    sql="""SELECT source_id, count(*) AS rows, sum(k)::BIGINT AS latency_sum, max(ts) AS last_seen, max_by(module, (ts, event_id)) AS last_module FROM v_silver GROUP BY source_id""",
)
def _(t: Tables):
    base = scratch_path(t.spark, "x13")
    s = silver_view(stream_of(t, "events"))
    R.snapshot_sink(R.observer_snapshot(s, "source_id", "module", "ts", "k"), f"{base}/out", f"{base}/state").awaitTermination()
    newest = max(UpsertTable(t.spark, f"{base}/out", ["source_id"]).versions())
    return t.spark.read.parquet(f"{base}/out/v{newest}")


@query(
    "x15_malformed_json", views=["v_env"],
    sql="SELECT b = 8 AS malformed, count(*) AS n FROM v_env GROUP BY 1",
)
def _(t: Tables):
    good, bad = DD.tolerant(envelope_view(stream_of(t, "events")).select("raw"), "metadata struct<row_hash:string>, data string", "raw")
    tagged = good.select(F.lit(False).alias("malformed")).unionByName(bad.select(F.lit(True).alias("malformed")))
    return drain(tagged, "x15").groupBy("malformed").agg(F.count("*").alias("n"))


@query(
    "x2_capacity",
    sql="""WITH u AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
        p AS (SELECT *, lag(i) OVER (PARTITION BY user_id ORDER BY i) AS before FROM u)
        SELECT p.event_id, before IS NULL OR (SELECT count(DISTINCT x.user_id) FROM u x WHERE x.i > p.before AND x.i < p.i) >= 100 AS accepted FROM p""",
)
def _(t: Tables):
    """A store that remembers the 100 vehicles used last: a row is a repeat while its vehicle is among them."""
    from motorpool.operators.reuse import capacity_outcomes

    return capacity_outcomes(t.events.select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"], 100).select("event_id", "accepted")


def _fifths(df):
    """The rows of five parts of the month, in order."""
    return [df.filter(F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4)) == part) for part in range(5)]


#: Value and counter of an event with gaps, as stand-ins for two sensors.
_GAPS = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS a, CASE WHEN event_id % 5 = 0 THEN NULL ELSE k::DOUBLE END AS b"


def sensor_rows(silver):
    gap = lambda n, c: F.when(F.col("event_id") % n != 0, F.col(c).cast("double"))
    return silver.select("source_id", "module", "ts", "event_id", gap(7, "value").alias("a"), gap(5, "k").alias("b"))


@query(
    "x6_stream_window_error", views=["v_silver"],
    sql=f"""WITH s AS (SELECT source_id, module, ts, event_id, {_GAPS} FROM v_silver),
        f AS (SELECT *, coalesce(last_value(a IGNORE NULLS) OVER w, 50.0::DOUBLE) AS fa, coalesce(last_value(b IGNORE NULLS) OVER w, 40.0::DOUBLE) AS fb FROM s
          WINDOW w AS (PARTITION BY source_id, module ORDER BY ts, event_id)),
        e AS (SELECT *, (fa - 50) / 30.0::DOUBLE AS za, (fb - 40) / 20.0::DOUBLE AS zb FROM f),
        r AS (SELECT *, (power(za - 0.6::DOUBLE * (0.6::DOUBLE * za + 0.8::DOUBLE * zb), 2) + power(zb - 0.8::DOUBLE * (0.6::DOUBLE * za + 0.8::DOUBLE * zb), 2)) / 2 AS e FROM e),
        n AS (SELECT *, sum(e) OVER w AS s, count(*) OVER w AS c, first_value(e) OVER w AS e0 FROM r
          WINDOW w AS (PARTITION BY source_id, module ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
        SELECT event_id, round((s + (30 - c) * e0) / 30, 6) AS error FROM n""",
)
def _(t: Tables):
    """Five micro-batches; fill values and the 29 rows before a row are carried from one to the next."""
    base = scratch_path(t.spark, "x6w")

    def start(src):
        out = P.window_errors(src, ["a", "b"], [50.0, 40.0], [(50.0, 30.0), (40.0, 20.0)], [[0.6], [0.8]])
        return append_sink(out, f"{base}/out", f"{base}/state", f"x6w-{base[-6:]}", trigger={"availableNow": True})

    with P.state_store(t.spark):
        R.in_steps(t.spark, _fifths(sensor_rows(t.silver)), f"{base}/in", start)
    return t.spark.read.schema("event_id long, error double").parquet(f"{base}/out").select("event_id", r6(F.col("error")).alias("error"))


@query(
    "x10_stream_restated", views=["v_silver"],
    sql=f"WITH {_gold_sql()} SELECT source_id, gold_window_ts, vehicle_health_score, engine_contrib, transmission_contrib FROM gold",
)
def _(t: Tables):
    """Every ninth row arrives in the last micro-batch, behind its vehicle's later windows; readers see the batch's result."""
    base = scratch_path(t.spark, "x10s")
    rows = t.silver.filter(F.col("module").isin(*H.Fusion().weights)).select("source_id", "module", "ts", "event_id", "health", "features")
    late = F.col("event_id") % 9 == 0
    parts = [*_thirds(rows.filter(~late)), rows.filter(late)]
    R.in_steps(t.spark, parts, f"{base}/in", lambda src: S.restating_sink(src, f"{base}/bronze", f"{base}/gold", f"{base}/state", buckets=16))
    return S.current_gold(t.spark, f"{base}/gold").select("source_id", "gold_window_ts", "vehicle_health_score", "engine_contrib", "transmission_contrib")


@query(
    "x4_closed_health_windows", views=["v_silver"],
    sql=f"""WITH {_gold_sql()} SELECT source_id, gold_window_ts, vehicle_health_score, engine_contrib, transmission_contrib FROM gold
        WHERE gold_window_ts + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM v_silver WHERE module IN ('engine', 'transmission'))""",
)
def _(t: Tables):
    """Append mode over three micro-batches: one row per window, after the watermark has passed its end."""
    base = scratch_path(t.spark, "x4c")
    rows = t.silver.filter(F.col("module").isin(*H.Fusion().weights)).select("source_id", "module", "ts", "event_id", "health", "features")

    def start(src):
        out = P.closed_health_windows(src, silence_seconds=60 * 86_400)
        return append_sink(out, f"{base}/out", f"{base}/state", f"x4c-{base[-6:]}", trigger={"availableNow": True})

    with P.state_store(t.spark):
        R.in_steps(t.spark, _thirds(rows), f"{base}/in", start)
    kept = "source_id string, gold_window_ts timestamp, vehicle_health_score double, engine_contrib double, transmission_contrib double"
    return t.spark.read.schema(kept).parquet(f"{base}/out")


@query(
    "x13_observer_history", views=["v_silver"],
    sql="""WITH good AS (SELECT * FROM v_silver WHERE event_id % 20 NOT BETWEEN 1 AND 7),
        card AS (SELECT source_id, count(*) FILTER (event_id % 20 NOT BETWEEN 1 AND 7) AS accepted, count(*) FILTER (event_id % 20 BETWEEN 1 AND 7) AS rejected FROM v_silver GROUP BY source_id)
        SELECT g.source_id, module, event_id, accepted, rejected, printf('%.1f', accepted::DOUBLE / (accepted + rejected) * 100)::DOUBLE AS validation_rate
        FROM good g JOIN card USING (source_id) QUALIFY row_number() OVER (PARTITION BY g.source_id, module ORDER BY ts DESC, event_id DESC) <= 3""",
)
def _(t: Tables):
    """Accepted and rejected rows as two inputs, three micro-batches; each vehicle's last card holds its modules' newest rows."""
    base = scratch_path(t.spark, "x13h")
    table = UpsertTable(t.spark, f"{base}/cards", ["source_id"])
    rows = t.silver.select("source_id", "module", "ts", "event_id", "k", F.col("value").cast("string").alias("payload"))
    bad = (F.col("event_id") % 20).between(1, 7)

    def start(src):
        src = src.withColumn("latency", F.col("k").cast("double"))
        return R.upsert_sink(P.observer_cards(src.filter(~bad), src.filter(bad), keep=3), table, f"{base}/state", mode="update")

    with P.state_store(t.spark):
        R.in_steps(t.spark, _thirds(rows), f"{base}/in", start)
    cards = table.read().select("source_id", "accepted", "rejected", F.explode("history").alias("module", "rows"))
    rate = round_py(F.col("accepted") / (F.col("accepted") + F.col("rejected")) * 100, 1).alias("validation_rate")
    return cards.select("source_id", "module", F.explode("rows.event_id").alias("event_id"), "accepted", "rejected", rate)


@query(
    "s9_stream_split", views=["v_env"],
    sql="""SELECT event_id, CASE WHEN b BETWEEN 1 AND 6 THEN 'dead' ELSE 'good' END AS sink, CASE WHEN b BETWEEN 1 AND 6 THEN strftime(ts, '%Y-%m-%d') END AS day FROM v_env""",
)
def _(t: Tables):
    """One parse per micro-batch feeds both sinks."""
    base = scratch_path(t.spark, "s9s")

    def start(src):
        return S.split_sink(
            src, lambda rows: with_row_error(rows, CONTRACT), f"{base}/good", f"{base}/dead", f"{base}/state",
            lambda bad: bad.select("event_id", "day", F.lit("schema_validation").alias("error_type"), "error.message", "error.details", F.col("data").alias("raw_row")),
            F.date_format("ts", "yyyy-MM-dd"),
        )

    R.in_steps(t.spark, _thirds(t.envelopes.select("event_id", "module", "data", "ts")), f"{base}/in", start)
    good = t.spark.read.schema("event_id long").parquet(f"{base}/good/v*").select("event_id", F.lit("good").alias("sink"), F.lit(None).cast("string").alias("day"))
    dead = t.spark.read.schema("event_id long, version long, day string").json(f"{base}/dead")
    return good.unionByName(dead.select("event_id", F.lit("dead").alias("sink"), "day"))


@query(
    "a2_stream_counters", views=["v_env"],
    sql="""SELECT module, count(*) AS attempted, count(*) FILTER (b NOT IN (1, 2, 3, 4, 5, 6, 7)) AS accepted,
        count(*) FILTER (b BETWEEN 1 AND 6) AS failed_validation, count(*) FILTER (b BETWEEN 1 AND 7) AS rejected FROM v_env GROUP BY module""",
)
def _(t: Tables):
    """Counters that the rows' own pass reports with each micro-batch, added up by the listener."""
    listener = R.ProgressMetrics()
    base = scratch_path(t.spark, "a2s")
    name = f"a2s-{base[-6:]}"
    outcome = F.when(F.col("error").isNotNull(), "invalid").when(F.col("row_hash") != F.concat(F.lit("h"), "event_id"), "duplicate").otherwise("accepted")
    modules = [*MODULE_OF.values(), "hull"]

    def start(src):
        checked = with_row_error(src, CONTRACT).withColumn("outcome", outcome)
        return append_sink(R.counted(checked, "ingest", "outcome", "module", modules).select("event_id", "outcome"), f"{base}/out", f"{base}/state", name, trigger={"availableNow": True})

    t.spark.streams.addListener(listener)
    try:
        R.in_steps(t.spark, _thirds(t.envelopes.select("event_id", "module", "data", "row_hash", "ts")), f"{base}/in", start)
        written = t.spark.read.parquet(f"{base}/out").count()
        _await(lambda: sum(v for k, v in listener.streams.get(name, {}).get("observed", {}).items() if k.endswith(".attempted")) >= written)
    finally:
        t.spark.streams.removeListener(listener)
    seen = listener.streams[name]["observed"]
    kinds = ("attempted", "accepted", "failed_validation", "rejected")
    rows = [(m, *[seen[f"{m}.{k}"] for k in kinds]) for m in modules if seen[f"{m}.attempted"]]
    return t.spark.createDataFrame(rows, "module string, " + ", ".join(f"{k} long" for k in kinds))


@query(
    "a7_sketch_rollup",
    sql="SELECT event_type AS module, count(*) AS rows, true AS distinct_close, true AS median_close FROM events GROUP BY event_type",
)
def _(t: Tables):
    """Sketches per module and day, stored day by day, rolled up to the module without reading rows again; the flags
    compare with the exact answers (3 % for distinct vehicles, 1 % in rank for the median)."""
    base = scratch_path(t.spark, "a7s")
    rows = t.events.select(F.col("event_type").alias("module"), F.to_date("ts").alias("day"), "user_id", "value", "ts")
    for part in _thirds(rows):
        O.sketches(part, ["module", "day"], "user_id", "value").write.mode("append").parquet(f"{base}/days")
    rolled = O.rolled_up(t.spark.read.parquet(f"{base}/days"), ["module"], {"p50": 0.5})
    exact = rows.join(F.broadcast(rolled.select("module", "p50")), "module").groupBy("module").agg(
        F.count_distinct("user_id").alias("_d"), F.avg((F.col("value") <= F.col("p50")).cast("double")).alias("_r"),
    )
    close = lambda a, b, e: F.abs(a - b) <= e
    return rolled.join(exact, "module").select(
        "module", "rows", close(F.col("distinct_values") / F.col("_d"), F.lit(1.0), 0.03).alias("distinct_close"),
        close(F.col("_r"), F.lit(0.5), 0.01).alias("median_close"),
    )

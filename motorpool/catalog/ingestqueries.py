"""Sources, sinks, contract and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.registry import MODULE_OF, Tables, query
from motorpool.contract import ColumnSpec, Contract, build_contract, contract_violations
from motorpool.operators import validate as V
from motorpool.plans import bronze as B
from motorpool.session import scratch_path
from motorpool.sources import files, streams, tables

_COLS = (ColumnSpec("timestamp", "object"), ColumnSpec("cents", "float64"), ColumnSpec("k", "float64"))
CONTRACT = Contract({m: _COLS for m in MODULE_OF.values()})
_EVENT_COLS = ["event_id", "user_id", "event_type"]


def _csv(t: Tables) -> str:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.events.select(*_EVENT_COLS).repartition(4, "user_id").sortWithinPartitions("event_id"), path)
    return path


@query("s1_read_csv_rows_resume", sql="SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type FROM events")
def _(t: Tables):
    """Reads in two steps, the second one resuming behind the checkpoint of the first."""
    path = _csv(t)
    every = files.read_rows(t.spark, path, _EVENT_COLS)
    first = every.filter("row_index <= 99")
    marks = first.groupBy("source_file").agg(F.max("row_index").alias("last_row_index"))
    rest = files.resume_rows(every, marks)
    return first.unionByName(rest).select(*_EVENT_COLS)


_LISTING = f"""SELECT DISTINCT '/data/sim' || user_id || '/' || event_type || '_' || (event_id % 2) || '.csv' AS path FROM events WHERE event_id % 3 > 0 OR user_id % 2 = 0"""


def _listing(t: Tables):
    name = F.concat(F.lit("/data/sim"), "user_id", F.lit("/"), "event_type", F.lit("_"), F.col("event_id") % 2, F.lit(".csv"))
    return t.events.filter("event_id % 3 > 0 OR user_id % 2 = 0").select(name.alias("path")).distinct()


@query(
    "s2_discover_sources",
    sql=f"""WITH l AS ({_LISTING}), f AS (SELECT path, split_part(path, '/', 3) AS vehicle, split_part(split_part(path, '/', 4), '_', 1) AS et FROM l),
        m(module, et) AS (VALUES {", ".join(f"('{m}', '{e}')" for e, m in MODULE_OF.items())})
        SELECT v.vehicle, m.module, count(f.path) AS files, CASE WHEN count(f.path) = 1 THEN min(f.path) END AS path,
        CASE WHEN count(f.path) = 0 THEN 'missing' WHEN count(f.path) > 1 THEN 'ambiguous' END AS error
        FROM (SELECT DISTINCT vehicle FROM f) v CROSS JOIN m LEFT JOIN f ON f.vehicle = v.vehicle AND f.et = m.et GROUP BY v.vehicle, m.module""",
)
def _(t: Tables):
    return files.discover_sources(_listing(t), {m: f"^{e}_" for e, m in MODULE_OF.items()})


@query(
    "j8_source_completeness",
    sql="""WITH v AS (SELECT DISTINCT user_id FROM events), e AS (SELECT DISTINCT event_type FROM events)
        SELECT v.user_id, e.event_type, count(x.event_id) AS n FROM v CROSS JOIN e LEFT JOIN events x USING (user_id, event_type)
        GROUP BY ALL HAVING count(x.event_id) < 10""",
)
def _(t: Tables):
    kinds = F.explode(F.array(*[F.lit(e) for e in MODULE_OF]))
    expected = t.events.select("user_id").distinct().select("user_id", kinds.alias("event_type"))
    actual = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    joined = expected.join(actual, ["user_id", "event_type"], "left")
    return joined.select("user_id", "event_type", F.coalesce("n", F.lit(0)).alias("n")).filter("n < 10")


@query(
    "s3_stream_source", sql="SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def _(t: Tables):
    src = streams.file_source(t.spark, t.dir, t.table("events").schema, glob="events.parquet", max_files=1)
    return streams.drain(src.select("event_id", "event_type"), "s3").groupBy("event_type").agg(F.count("*").alias("n"))


_TOPICS = {m: f"telemetry.{m}" for m in MODULE_OF.values()}


@query(
    "s4_broker_rows", views=["v_env"],
    sql="""SELECT vehicle AS key, data AS value, 'telemetry.' || module AS topic FROM v_env WHERE module <> 'hull'
        UNION ALL SELECT vehicle, data, 'dlq' FROM v_env WHERE module = 'hull'""",
)
def _(t: Tables):
    good, bad = streams.to_broker_rows(t.envelopes, _TOPICS, F.col("data"), key="vehicle")
    return good.unionByName(bad.select(F.col("vehicle").alias("key"), F.col("data").alias("value"), F.lit("dlq").alias("topic")))


@query("s5_bronze_sink", sql="SELECT user_id AS source_id, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY user_id")
def _(t: Tables):
    """Bronze is laid out by source bucket: pruning as with one folder per source, without its many small files."""
    src = streams.file_source(t.spark, t.dir, t.table("events").schema, glob="events.parquet")
    rows = streams.by_source(src.select(F.col("user_id").alias("source_id"), "event_id"), "source_id", "event_id", 16)
    back = streams.drain(rows, "s5", ("source_bucket",))
    return back.groupBy("source_id").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    "s6_incremental_read",
    sql="""SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' ORDER BY ts, event_id LIMIT 500""",
)
def _(t: Tables):
    mark = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    raw = t.table("events").select("event_id", "ts", "value")
    return files.newer_than(raw, "ts", mark, 500, ("event_id",)).withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "s6_incremental_capped_reads",
    sql="SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-11 00:00:00'",
)
def _(t: Tables):
    """Whole days as the time column, so that every cap cuts through rows of one time."""
    days = t.events.select("event_id", F.to_date("ts").alias("day"))
    return files.read_capped(days, "day", ("event_id",), F.lit("2024-01-10").cast("date"), 5_000, scratch_path(t.spark, "s6"))


@query(
    "s6_incremental_read_per_vehicle",
    sql="""WITH m AS (SELECT user_id, max(ts) AS t, max_by(event_id, (ts, event_id)) AS h FROM events WHERE ts < TIMESTAMP '2024-01-12' GROUP BY user_id)
        SELECT event_id, user_id FROM (SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS r
        FROM events e LEFT JOIN m USING (user_id) WHERE m.t IS NULL OR (e.ts, e.event_id) > (m.t, m.h)) WHERE r <= 5""",
)
def _(t: Tables):
    ev = t.events.select("event_id", "user_id", "ts")
    seen = ev.filter(F.col("ts") < F.lit("2024-01-12").cast("timestamp"))
    marks = seen.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.*")
    return files.newer_per_key(ev, marks, ["user_id"], "ts", "event_id", 5).select("event_id", "user_id")


@query(
    "s7_append_with_schema_merge",
    sql="""SELECT event_id, user_id, NULL::DOUBLE AS value FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, user_id, value FROM events WHERE event_type <> 'click'""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "s7")
    files.append(t.events.filter("event_type = 'click'").select("event_id", "user_id"), path)
    files.append(t.events.filter("event_type <> 'click'").select("event_id", "user_id", "value"), path)
    return files.read_merged(t.spark, path).select("event_id", "user_id", "value")


_EARLY, _LATE = "ts < TIMESTAMP '2024-01-20'", "ts >= TIMESTAMP '2024-01-15'"


def _versions(t: Tables):
    per = lambda cond: t.events.filter(cond).groupBy("user_id", "event_type").agg(
        F.max("value").alias("peak"), F.count("*").alias("n")
    )
    return per(_EARLY), per(_LATE)


_PER = "SELECT user_id, event_type, max(value) AS peak, count(*) AS n FROM events WHERE {c} GROUP BY ALL"


@query(
    "s8_upsert_table",
    sql=f"""WITH t AS ({_PER.format(c=_EARLY)}), u AS ({_PER.format(c=_LATE)})
        SELECT * FROM u UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.user_id = t.user_id AND u.event_type = t.event_type)""",
)
def _(t: Tables):
    target, updates = _versions(t)
    table = tables.UpsertTable(t.spark, scratch_path(t.spark, "s8"), ["user_id", "event_type"])
    table.upsert(target)
    table.upsert(updates)
    return table.read()


@query(
    "j5_upsert_split",
    sql=f"""WITH t AS ({_PER.format(c=_EARLY)}), u AS ({_PER.format(c=_LATE)})
        SELECT user_id, event_type, CASE WHEN t.n IS NULL THEN 'inserted' WHEN u.n IS NULL THEN 'untouched' ELSE 'updated' END AS action
        FROM t FULL JOIN u USING (user_id, event_type)""",
)
def _(t: Tables):
    return tables.upsert_split(*_versions(t), ["user_id", "event_type"])


@query(
    "s9_dead_letters", views=["v_env"],
    sql="""SELECT vehicle AS source_id, 'schema_validation' AS error_type, data AS raw_row, strftime(ts, '%Y-%m-%d') AS day
        FROM v_env WHERE b IN (1, 2, 3, 4, 5, 6)""",
)
def _(t: Tables):
    _, bad = V.split_valid(V.with_row_error(t.envelopes.select("vehicle", "module", "data", "ts"), CONTRACT))
    rows = files.dead_letters(
        bad.withColumn("source_id", F.col("vehicle")), F.lit("schema_validation"), F.col("error.message"),
        F.col("error.details"), F.col("data"), F.col("ts"),
    ).select("source_id", "day", "error_type", "error_message", "error_details", "raw_row")
    path = scratch_path(t.spark, "s9")
    files.write_dead_letters(rows, path)
    schema = "source_id string, day string, error_type string, raw_row string"
    return t.spark.read.schema(schema).json(path).select("source_id", "error_type", "raw_row", "day")


@query("s10_drop_columns_csv", sql="SELECT event_id::VARCHAR AS event_id, event_type FROM events")
def _(t: Tables):
    rows = files.read_rows(t.spark, _csv(t), _EVENT_COLS).drop("row_index", "source_file")
    path = scratch_path(t.spark, "s10")
    files.write_csv(files.drop_present(rows, ["user_id", "absent"]), path)
    return t.spark.read.csv(path, header=True, schema="event_id string, event_type string")


def _commits(t: Tables):
    i = F.col("event_id")
    path = F.concat(F.lit("part-"), F.floor(i / 2))
    add = F.to_json(F.struct(F.struct(path.alias("path"), F.to_json(F.struct((i % 50).alias("numRecords"))).alias("stats")).alias("add")))
    gone = F.to_json(F.struct(F.struct(path.alias("path")).alias("remove")))
    line = F.when(i % 10 == 1, gone).otherwise(add)
    return t.events.select(F.col("event_type").alias("module"), line.alias("value"))


@query(
    "s11_commit_log_rows",
    sql="SELECT event_type AS module, sum(CASE WHEN event_id % 10 = 1 THEN 0 ELSE event_id % 50 END)::BIGINT AS rows FROM events GROUP BY 1",
)
def _(t: Tables):
    return files.commit_log_counts(_commits(t), ["module"])


@query(
    "s11_commit_log_rows_net",
    sql="""SELECT module, coalesce(sum(n), 0)::BIGINT AS rows FROM (SELECT event_type AS module, event_id // 2 AS f,
        sum(CASE WHEN event_id % 10 = 1 THEN 0 ELSE event_id % 50 END) AS n, bool_or(event_id % 10 = 1) AS gone FROM events GROUP BY ALL)
        WHERE NOT gone GROUP BY module""",
)
def _(t: Tables):
    return files.commit_log_counts(_commits(t), ["module"], subtract_removed=True)


@query(
    "s12_nested_state_rows",
    sql="SELECT event_type || '-' || user_id AS stream, count(*) AS total_rows, max(event_id) AS backlog FROM events GROUP BY event_type, user_id",
)
def _(t: Tables):
    per = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("total_rows"), F.max("event_id").alias("backlog"))
    name = F.concat_ws("-", "event_type", "user_id")
    doc = F.to_json(F.struct(F.create_map(name, F.struct("total_rows", "backlog")).alias("streams")))
    return files.explode_metrics(per.select(doc.alias("value"))).select("stream", "total_rows", "backlog")


@query("s13_recent_files", sql="SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('purchase', 'signup', 'view') GROUP BY event_type")
def _(t: Tables):
    """One file per event type, written in order of name; the three newest are read."""
    path = scratch_path(t.spark, "s13")
    kinds = [r.event_type for r in t.events.select("event_type").distinct().orderBy("event_type").collect()]
    for i, kind in enumerate(kinds):
        t.events.filter(F.col("event_type") == kind).coalesce(1).write.parquet(f"{path}/{kind}")
        files.set_modified(t.spark, f"{path}/{kind}/*.parquet", 1_700_000_000_000 + 1000 * i)
    every = t.spark.read.option("recursiveFileLookup", "true").parquet(path)
    return files.recent_files(every, 3).groupBy("event_type").agg(F.count("*").alias("n"))


@query("s14_export_csv", sql="SELECT event_type, count(*)::VARCHAR AS n FROM events GROUP BY event_type")
def _(t: Tables):
    path = scratch_path(t.spark, "s14")
    files.write_csv(t.events.groupBy("event_type").agg(F.count("*").alias("n")), path)
    return t.spark.read.csv(path, header=True, schema="event_type string, n string")


# -- contract and validation ------------------------------------------------------------


@query(
    "c1_contract_schema", views=["v_env"],
    sql="""SELECT event_id, vehicle, CASE WHEN b IN (1, 6) THEN NULL ELSE cents::DOUBLE END AS cents, CASE WHEN b = 2 THEN NULL ELSE k::DOUBLE END AS k
        FROM v_env WHERE b NOT IN (5, 8)""",
)
def _(t: Tables):
    """Every module's rows under its own schema; rows of unknown modules have none."""
    rows = B.by_module(t.envelopes, CONTRACT, ["event_id"], value="raw").filter("_p is not null")
    return rows.select("event_id", F.col("_p.metadata.vehicle_id").alias("vehicle"), "_p.data.cents", "_p.data.k")


@query(
    "c2_contract_self_check",
    sql="""SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'version is not v1' END AS bad_version, count(*) FILTER (w) AS wrong_counts FROM (
        SELECT user_id, event_type, count(DISTINCT event_id % 7) <> 7 AS w FROM events GROUP BY ALL) GROUP BY user_id
        HAVING user_id % 3 = 0 OR count(*) FILTER (w) > 0""",
)
def _(t: Tables):
    """One small contract per vehicle: a column per residue seen, a declared count of seven."""
    per = t.events.groupBy("user_id", "event_type").agg(F.array_sort(F.collect_set(F.col("event_id") % 7)).alias("ks"))
    spec = F.struct(F.lit("float64").alias("dtype"), F.lit(False).alias("nullable"))
    columns = F.map_from_entries(F.transform("ks", lambda k: F.struct(F.concat(F.lit("c"), k), spec)))
    mod = F.struct("event_type", F.struct(F.lit(7).alias("column_count"), columns.alias("columns")).alias("v"))
    docs = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(mod)).alias("modules"))
    meta = F.create_map(*[x for m in ("row_hash", "vehicle_id", "module", "source_file") for x in (F.lit(m), F.lit("string"))])
    rules = F.create_map(*[x for r in CONTRACT.rules for x in (F.lit(r), F.lit(True))])
    version = F.when(F.col("user_id") % 3 == 0, "v0").otherwise("v1")
    text = F.to_json(F.struct(version.alias("contract_version"), "modules", meta.alias("metadata"), rules.alias("validation_rules"), "user_id"))
    bad = contract_violations(docs.select(text.alias("value")))
    return bad.groupBy(F.get_json_object("value", "$.user_id").cast("long").alias("user_id")).agg(
        F.max(F.when(F.col("violation").startswith("version"), F.col("violation"))).alias("bad_version"),
        F.count_if(F.col("violation").endswith("differs")).alias("wrong_counts"),
    )


_MSG = """CASE WHEN b = 5 THEN 'Unknown module' WHEN b IN (2, 3, 4) THEN 'Column order mismatch'
    WHEN b IN (1, 6) THEN 'Schema validation failed' END"""


@query("c3_strict_row_validation", views=["v_env"], sql=f"SELECT event_id, {_MSG} AS message FROM v_env")
def _(t: Tables):
    checked = V.with_row_error(t.envelopes.select("event_id", "module", "data"), CONTRACT)
    return checked.select("event_id", "error.message")


@query(
    "c3_unordered_row_validation", views=["v_env"],
    sql="""SELECT event_id, CASE b WHEN 5 THEN 'hull' WHEN 3 THEN '["spare"]' WHEN 2 THEN '["k: missing or null"]'
        WHEN 1 THEN '["cents: not double"]' ELSE '["cents: missing or null"]' END AS details FROM v_env WHERE b IN (1, 2, 3, 5, 6)""",
)
def _(t: Tables):
    free = Contract(CONTRACT.modules, {**CONTRACT.rules, "enforce_column_order": False})
    _, bad = V.split_valid(V.with_row_error(t.envelopes.select("event_id", "module", "data"), free))
    return bad.select("event_id", "error.details")


@query(
    "c4_envelope_validation", views=["v_env"],
    sql="SELECT event_id, CASE b WHEN 8 THEN 'malformed envelope' ELSE 'unknown module' END AS problem FROM v_env WHERE b IN (5, 8)",
)
def _(t: Tables):
    checked = V.with_envelope_error(t.envelopes.select("event_id", "raw"), CONTRACT, "raw")
    return checked.select("event_id", "problem").filter("problem IS NOT NULL")


@query(
    "c5_schema_profile",
    sql=" UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS column, '{ty}' AS dtype, bool_or({c} IS NULL) AS has_null, min({c}::VARCHAR) AS example FROM events"
        for i, (c, ty) in enumerate([("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("props", "string")])
    ),
)
def _(t: Tables):
    return V.schema_profile(t.events.select("event_id", "user_id", "event_type", "props"))


_HEAD = "SELECT user_id::VARCHAR AS vehicle, 'log' AS module, list(DISTINCT event_type || (CASE WHEN user_id % 4 = 1 AND event_type = 'view' THEN '2' ELSE '' END)) AS cols FROM events GROUP BY user_id"


@query(
    "c6_header_consistency",
    sql="""SELECT user_id::VARCHAR AS vehicle, CASE WHEN user_id % 4 = 1 THEN ['view'] ELSE [] END AS missing,
        CASE WHEN user_id % 4 = 1 THEN ['view2'] ELSE [] END AS extra, user_id % 4 = 2 AS order_only
        FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 4 IN (1, 2) AND user_id > 0""",
)
def _(t: Tables):
    """Header of each vehicle: all event types, one renamed or the order reversed for some."""
    u = F.col("user_id")
    kind = F.when((u % 4 == 1) & (F.col("event_type") == "view"), "view2").otherwise(F.col("event_type"))
    every = F.sort_array(F.collect_set(kind))
    heads = t.events.groupBy("user_id").agg(F.when(u % 4 == 2, F.reverse(every)).otherwise(every).alias("cols"))
    heads = heads.select(u.cast("string").alias("vehicle"), F.lit("log").alias("module"), "cols")
    return V.header_mismatches(heads, "0").drop("module")


@query(
    "c7_feature_compatibility", views=["v_silver"],
    sql="""WITH w AS (SELECT source_id, list_sort(list(DISTINCT 'f' || (k % 10))) AS cols FROM v_silver GROUP BY source_id)
        SELECT source_id, list_sort(list_filter(['f1', 'f5', 'f12'], lambda x: NOT list_contains(cols, x))) AS missing,
        list_sort(list_filter(cols, lambda x: NOT list_contains(['f1', 'f5', 'f12'], x))) AS unused FROM w""",
)
def _(t: Tables):
    cols = F.collect_set(F.concat(F.lit("f"), F.col("k") % 10))
    per = t.silver.groupBy("source_id").agg(F.sort_array(F.concat(cols, F.array(F.lit("timestamp")))).alias("cols"))
    found = V.feature_compatibility(F.array(*map(F.lit, ("f1_mean", "f1_std", "f5", "f12"))), F.col("cols"))
    return per.select("source_id", *[F.sort_array(c).alias(n) for n, c in found.items()])


# Small stand-in fault catalogue (fixed values).
DTC_ROWS = [
    (m, f"P{i}{j}", "critical" if j % 2 == 0 else "non_critical", [f"f{(i + j) % 10}", f"f{(i + 3 * j + 1) % 12}"], f"Check {m} {j}")
    for i, m in enumerate(MODULE_OF.values()) for j in range(4)
] + [("tyre", "P00", "non_critical", ["f1", "f2"], "Check the code two modules share")]


def dtc_catalog(t: Tables):
    return t.spark.createDataFrame(DTC_ROWS, "module string, dtc_code string, severity string, features array<string>, message string")


_DTC = "dtc(module, dtc_code, severity, features, message) AS (VALUES " + ", ".join(
    f"('{m}', '{c}', '{s}', {f}, '{x}')" for m, c, s, f, x in DTC_ROWS
) + ")"


@query(
    "c8_dtc_compatibility", views=["v_feat"],
    sql=f"""WITH {_DTC}, have AS (SELECT DISTINCT module, feature FROM v_feat),
        need AS (SELECT module, dtc_code, unnest(features) AS feature FROM dtc)
        SELECT n.module, n.dtc_code, list_sort(list(n.feature)) AS absent FROM need n LEFT JOIN have h ON h.module = n.module AND h.feature = n.feature
        WHERE h.feature IS NULL GROUP BY ALL""",
)
def _(t: Tables):
    absent, _summary = V.dtc_compatibility(dtc_catalog(t), t.feats.select("module", F.col("feature").alias("column")))
    return absent


@query(
    "c8_dtc_compatibility_summary", views=["v_feat"],
    sql=f"""WITH {_DTC}, have AS (SELECT DISTINCT module, feature FROM v_feat),
        bad AS (SELECT DISTINCT n.module, n.dtc_code FROM (SELECT module, dtc_code, unnest(features) AS feature FROM dtc) n
          LEFT JOIN have h ON h.module = n.module AND h.feature = n.feature WHERE h.feature IS NULL)
        SELECT dtc.module, count(*) - count(bad.dtc_code) AS n_ok, count(*) AS n_total FROM dtc LEFT JOIN bad USING (module, dtc_code) GROUP BY dtc.module""",
)
def _(t: Tables):
    return V.dtc_compatibility(dtc_catalog(t), t.feats.select("module", F.col("feature").alias("column")))[1]


@query(
    "c9_sensor_policy", views=["v_silver"],
    sql="""SELECT source_id, module, CASE WHEN len(m) > 3 THEN 'abort' WHEN len(m) > 0 THEN 'mask' ELSE 'ok' END AS action, len(m) AS n_missing FROM (
        SELECT source_id, module, list_filter(['f0', 'f1', 'f2', 'f3', 'f4', 'f5', 'f6', 'f7', 'f8', 'f9'], lambda x: NOT list_contains(list('f' || (k % 10)), x)) AS m
        FROM v_silver GROUP BY source_id, module)""",
)
def _(t: Tables):
    seen = t.silver.groupBy("source_id", "module").agg(F.collect_set(F.concat(F.lit("f"), F.col("k") % 10)).alias("cols"))
    action, missing = V.sensor_policy(F.array(*[F.lit(f"f{i}") for i in range(10)]), F.col("cols"))
    return seen.select("source_id", "module", action.alias("action"), F.size(missing).alias("n_missing"))


@query(
    "c10_valid_files",
    sql="""SELECT user_id FROM events GROUP BY user_id HAVING avg((value > 90)::INT) >= 0.1 AND avg((event_id % 3 = 0)::INT) >= 0.1""",
)
def _(t: Tables):
    df = t.events.select(
        "user_id", "ts", F.when(F.col("value") > 90, F.col("value")).alias("a"), F.when(F.col("event_id") % 3 == 0, F.lit(1)).alias("b")
    )
    return V.valid_files(df, "user_id", ["a", "b"])


@query(
    "c11_header_resolver",
    sql="""SELECT user_id, 'GPS ' || min(event_type) || ' Speed' AS speed, 'Engine RPM' AS rpm FROM events WHERE user_id % 3 <> 0 GROUP BY user_id""",
)
def _(t: Tables):
    heads = t.events.groupBy("user_id").agg(F.min("event_type").alias("e")).select(
        "user_id", F.array(F.lit("Time"), F.concat(F.lit("GPS "), "e", F.lit(" Speed")),
                           F.when(F.col("user_id") % 3 == 0, "Torque").otherwise("Engine RPM")).alias("cols")
    )
    got = V.resolve_header_rows(F.col("cols"), {"speed": "speed", "rpm": "engine rpm"})
    return heads.select("user_id", got.alias("m")).filter("m IS NOT NULL").select(
        "user_id", F.col("m")["speed"].alias("speed"), F.col("m")["rpm"].alias("rpm")
    )


@query(
    "c12_contract_build",
    sql="""SELECT sha256(doc) AS checksum, length(doc) AS size FROM (SELECT '{"contract_version":"v1","modules":[' || string_agg(
        '{"module":"' || event_type || '","column_count":' || n || ',"columns":[' || cols || ']}', ',' ORDER BY event_type) || ']}' AS doc FROM (
        SELECT event_type, count(*) AS n, string_agg('{"ordinal":' || o || ',"column":"c' || o || '","dtype":"float64","nullable":false}', ',' ORDER BY o) AS cols
        FROM (SELECT DISTINCT event_type, user_id % 12 AS o FROM events) GROUP BY event_type))""",
)
def _(t: Tables):
    o = (F.col("user_id") % 12).cast("int")
    cols = t.events.select(F.col("event_type").alias("module"), o.alias("ordinal")).distinct().select(
        "module", "ordinal", F.concat(F.lit("c"), "ordinal").alias("column"), F.lit("float64").alias("dtype"), F.lit(False).alias("nullable")
    )
    return build_contract(cols).select("checksum", F.length("document").alias("size"))


# -- bronze -----------------------------------------------------------------------------


@query(
    "p1_flatten_envelope", views=["v_env"],
    sql="""SELECT row_hash, vehicle AS source_id, stamp AS timestamp, CASE WHEN b IN (1, 6) THEN NULL ELSE cents::DOUBLE END AS cents,
        CASE WHEN b = 2 THEN NULL ELSE k::DOUBLE END AS k FROM v_env WHERE b NOT IN (5, 8)""",
)
def _(t: Tables):
    rows, _bad = B.split_unreadable(B.flatten_all(t.envelopes, CONTRACT, value="raw"))
    return rows.select("row_hash", "source_id", "timestamp", "cents", "k")


@query(
    "p2_row_hash",
    sql="""SELECT event_id, sha256('{"features":{"event_id":"' || event_id || '","event_type":"' || event_type || '","user_id":"' || user_id
        || '"},"module":"' || event_type || '","timestamp":"' || epoch_us(ts) || '","vehicle_id":"' || user_id || '"}') AS row_hash FROM events""",
)
def _(t: Tables):
    h = B.row_hash(["user_id", "event_type", "event_id"], F.col("event_type"), F.col("user_id").cast("string"), F.unix_micros("ts"))
    return t.events.select("event_id", h.alias("row_hash"))


@query("p3_server_stamp", sql="SELECT event_id, TIMESTAMP '2026-01-01 00:00:00' AS ingest_ts FROM events")
def _(t: Tables):
    return B.stamp(t.events.select("event_id"), "ingest_ts", F.lit("2026-01-01 00:00:00").cast("timestamp"))


@query(
    "j6_seen_before", views=["v_env"],
    sql="SELECT event_id, row_hash FROM v_env WHERE row_hash NOT IN (SELECT row_hash FROM v_env WHERE ts < TIMESTAMP '2024-01-10')",
)
def _(t: Tables):
    return tables.unseen(t.envelopes.select("event_id", "row_hash"), t.envelopes.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp")), ["row_hash"])


@query("u3_exact_dedup", views=["v_env"], sql="SELECT min(event_id) AS event_id, row_hash FROM v_env GROUP BY row_hash")
def _(t: Tables):
    return V.first_occurrence(t.envelopes.select("row_hash", "event_id"), ["row_hash"], ["event_id"])


@query(
    "u1_union_modules",
    sql="""SELECT event_id AS id, 'engine' AS module, value AS rpm, NULL::BIGINT AS volts FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, 'battery', NULL, user_id FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT event_id, CASE event_type WHEN 'view' THEN 'transmission' WHEN 'signup' THEN 'body' ELSE 'tyre' END, NULL, NULL
        FROM events WHERE event_type IN ('view', 'signup', 'error')""",
)
def _(t: Tables):
    eng = t.events.filter("event_type = 'click'").select(F.col("event_id").alias("id"), F.lit("engine").alias("module"), F.col("value").alias("rpm"))
    bat = t.events.filter("event_type = 'purchase'").select(F.col("event_id").alias("id"), F.lit("battery").alias("module"), F.col("user_id").alias("volts"))
    rest = [
        t.events.filter(F.col("event_type") == e).select(F.col("event_id").alias("id"), F.lit(m).alias("module")) for e, m in MODULE_OF.items() if m not in ("engine", "battery")
    ]
    return files.union_merged(eng, bat, *rest)


@query(
    "u2_set_difference",
    sql="""WITH a AS (SELECT DISTINCT user_id, event_id % 9 AS c FROM events WHERE event_type = 'click'),
        b AS (SELECT DISTINCT user_id, event_id % 9 AS c FROM events WHERE event_type = 'view')
        SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def _(t: Tables):
    side = lambda e: t.events.filter(F.col("event_type") == e).select("user_id", (F.col("event_id") % 9).alias("c"))
    a, b = side("click"), side("view")
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))

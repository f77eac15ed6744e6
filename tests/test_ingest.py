"""Contract, validation, sources and sinks on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from motorpool.contract import ColumnSpec, Contract, contract_violations
from motorpool.functions import timefmt
from motorpool.operators import validate as V
from motorpool.plans import bronze as B
from motorpool.plans import dtc as D
from motorpool.sources import files, streams, tables

CONTRACT = Contract({"engine": (ColumnSpec("timestamp", "object"), ColumnSpec("rpm", "float64"), ColumnSpec("load", "float64"))})

ROWS = [
    ("engine", '{"timestamp":"t","rpm":1.5,"load":2}', None),
    ("engine", '{"timestamp":"t","rpm":"1.5","load":" 2 "}', None),
    ("engine", '{"timestamp":"t","rpm":"","load":2}', "Schema validation failed"),
    ("engine", '{"timestamp":"t","rpm":null,"load":2}', "Schema validation failed"),
    ("engine", '{"timestamp":5,"rpm":1,"load":2}', "Schema validation failed"),
    ("engine", '{"timestamp":"t","load":2,"rpm":1}', "Column order mismatch"),
    ("engine", '{"timestamp":"t","rpm":1}', "Column order mismatch"),
    ("engine", '{"timestamp":"t","rpm":1,"load":2,"x":3}', "Column order mismatch"),
    ("hull", '{"timestamp":"t"}', "Unknown module"),
    ("engine", '{"timestamp":', "Malformed row"),
]


def test_strict_rows(spark):
    df = spark.createDataFrame([(i, m, d) for i, (m, d, _) in enumerate(ROWS)], "i int, module string, data string")
    got = {r.i: r.error.message if r.error else None for r in V.with_row_error(df, CONTRACT).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(ROWS)}


def test_split_keeps_every_row_and_parses_once(spark):
    df = spark.createDataFrame([(i, m, d) for i, (m, d, _) in enumerate(ROWS)], "i int, module string, data string")
    good, bad = V.split_valid(V.with_row_error(df, CONTRACT))
    assert good.count() == 2 and bad.count() == 8
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantType") == 1


def test_envelope(spark):
    meta = {"row_hash": "h", "vehicle_id": "v", "module": "engine", "source_file": "f"}
    cases = [
        ({"metadata": meta, "data": {}}, None),
        ({"metadata": {**meta, "row_hash": ""}, "data": {}}, "metadata missing: row_hash"),
        ({"metadata": {**meta, "zzz": "1"}, "data": {}}, "unexpected envelope fields"),
        ({"metadata": meta, "data": {}, "more": 1}, "unexpected envelope fields"),
        ({"metadata": {**meta, "module": "hull"}, "data": {}}, "unknown module"),
        ({"data": {}}, "malformed envelope"),
    ]
    df = spark.createDataFrame([(i, json.dumps(e)) for i, (e, _) in enumerate(cases)] + [(99, "{oops")], "i int, raw string")
    got = {r.i: r.problem for r in V.with_envelope_error(df, CONTRACT, "raw").collect()}
    assert got == {**{i: w for i, (_, w) in enumerate(cases)}, 99: "malformed envelope"}


def contract_doc(**changes):
    doc = {
        "contract_version": "v1", "modules": {"engine": {"column_count": 1, "columns": {"a": {"dtype": "float64", "nullable": False}}}},
        "metadata": {m: "string" for m in ("row_hash", "vehicle_id", "module", "source_file")},
        "validation_rules": {r: r != "allow_extra_fields" for r in CONTRACT.rules},
    }
    return json.dumps({**doc, **changes})


def test_contract_document(spark):
    docs = [(contract_doc(),), (contract_doc(contract_version="v2"),), (contract_doc(modules={"engine": {"column_count": 3, "columns": {}}}),)]
    bad = contract_violations(spark.createDataFrame(docs, "value string")).collect()
    assert sorted(r.violation for r in bad) == ["engine: column_count differs", "version is not v1"]
    c = Contract.from_json(contract_doc())
    assert c.columns("engine") == ["a"] and c.rules["allow_extra_fields"] is False
    assert c.data_schema("engine").simpleString() == "struct<a:double>"


def test_timestamps(spark):
    texts = ["2024-07-05T08:00:00Z", "2024-07-05T08:00:00.250+00:00", "2024-07-05 08:00:00+00:00", "2024-07-05 08:00:00", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(timefmt.parse_iso_ms(F.col("s"))).collect()]
    base = 1720166400000
    assert got == [base, base + 250, base, base, None, None]


def test_csv_index_spans_splits(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.read_rows(spark, str(path), ["a", "b"], start_after=9)
        got = rows.select(F.col("a").cast("long").alias("a"), "row_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 4990 and all(r.a == r.row_index for r in got)


def test_discovery(spark):
    paths = ["/d/sim1/engine_a.csv", "/d/sim1/tyre.csv", "/d/sim2/engine_a.csv", "/d/sim2/engine_b.csv", "/d/other/engine.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {(r.vehicle, r.module): r.error for r in files.discover_sources(df, {"engine": "^engine", "tyre": "^tyre"}, ["sim1", "sim2", "sim9"]).collect()}
    assert got == {
        ("sim1", "engine"): None, ("sim1", "tyre"): None, ("sim2", "engine"): "ambiguous", ("sim2", "tyre"): "missing", ("sim9", None): "unknown vehicle",
    }


def test_upsert_table_versions(spark, tmp_path):
    t = tables.UpsertTable(spark, str(tmp_path / "t"), ["id"])
    assert t.read() is None
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), version=0)
    late = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    t.upsert(late, version=1)
    t.upsert(late, version=1)  # a replayed batch
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "B"), (3, "c")]
    (tmp_path / "t" / "v7").mkdir()  # a version whose job died
    assert t.versions() == [0, 1]


def test_upsert_table_rewrites_touched_buckets_only(spark, tmp_path):
    path = tmp_path / "t"
    t = tables.UpsertTable(spark, str(path), ["id", "part"], keep=2, buckets=8)
    kind, plain = "id long, part string, v string", {}
    t.upsert(spark.createDataFrame([], kind))
    assert t.read().count() == 0 and t.read().columns == ["id", "part", "v"]
    for step in range(6):
        keys = [(k, None if (k or 1) % 3 else "a") for k in ([*range(60), None] if step == 0 else [step, step + 100, None])]
        before = {p: p.stat().st_mtime_ns for p in path.glob("v*/key_bucket=*/*.parquet")}
        t.upsert(spark.createDataFrame([(*k, f"v{step}") for k in keys], kind))
        plain |= {k: f"v{step}" for k in keys}
        assert {(r.id, r.part): r.v for r in t.read().collect()} == plain and t.read().count() == len(plain)
        newest = path / f"v{t.versions()[-1]}"
        assert step == 0 or 1 <= len(list(newest.glob("key_bucket=*"))) <= 3
        assert all(p.stat().st_mtime_ns == at for p, at in before.items() if p.exists())
    assert len(t.versions()) == 2 and len(list(path.glob("v*/key_bucket=*"))) <= 8 + 3  # what no kept version shows is gone
    narrow = spark.createDataFrame([(6, "a", "n"), (500, None, "n")], "id int, part string, v string")  # hashed as the table's type
    t.upsert(narrow)
    plain |= {(6, "a"): "n", (500, None): "n"}
    assert {(r.id, r.part): r.v for r in t.read().collect()} == plain
    t.upsert(spark.createDataFrame([(6, "a", "w", 1.5)], "id long, part string, v string, extra double"))
    got = {(r.id, r.part): (r.v, r.extra) for r in t.read().collect()}
    assert got == {k: (v, None) for k, v in plain.items()} | {(6, "a"): ("w", 1.5)}


def test_upsert_table_goes_on_after_versions_without_buckets(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(str(tmp_path / "t/v0"))
    t = tables.UpsertTable(spark, str(tmp_path / "t"), ["id"])
    t.upsert(spark.createDataFrame([(2, "B")], "id long, v string"))
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "B")] and t.versions() == [0, 1]


def test_all_modules_are_flattened_in_one_pass(spark):
    contract = Contract({
        "engine": (ColumnSpec("timestamp", "object"), ColumnSpec("rpm", "float64")),
        "tyre": (ColumnSpec("timestamp", "object"), ColumnSpec("psi", "float64")),
        "brake": (ColumnSpec("timestamp", "object"), ColumnSpec("psi", "float64")),
    })
    text = '{{"metadata":{{"row_hash":"h{i}","vehicle_id":"v","module":"{m}"}},"data":{{"timestamp":"t","rpm":{i},"psi":{i}.5}}}}'
    rows = [(m, text.format(i=i, m=m)) for i, m in enumerate(["engine", "tyre", "brake", "engine", "hull"])]
    rows += [("engine", rows[0][1][:-4]), ("tyre", None), (None, rows[1][1]), ("tyre", "5"), ("brake", '{"metadata":{}}')]
    raw = spark.createDataFrame(rows, "module string, value string")
    every, unread = B.split_unreadable(B.flatten_all(raw, contract).drop("writer_ts"))
    parts = [B.split_unreadable(B.flatten(raw.filter(f"module = '{m}'"), contract, m))[0].drop("writer_ts") for m in contract.modules]
    for m, part in zip(contract.modules, parts, strict=True):
        own = every.filter(f"module = '{m}'")
        assert sorted(map(tuple, own.select(*part.columns).collect())) == sorted(map(tuple, part.collect()))
        absent = {"rpm", "psi"} - set(part.columns)
        assert own.filter(" or ".join(f"{c} is not null" for c in absent)).count() == 0
    assert every.count() == 4 and unread.count() == 6
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 2  # engine's schema, and the one that tyre and brake share


def test_header_resolver():
    assert V.resolve_headers(["Time", "GPS Speed (km/h)"], {"speed": "speed", "time": "TIME"}) == {"speed": "GPS Speed (km/h)", "time": "Time"}
    assert V.resolve_headers(["Time"], {"speed": "speed"}) is None


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_source(spark, "engine", "broker:9092")


def test_kafka_sink_needs_its_connector(spark, tmp_path):
    rows = spark.readStream.format("rate").load().selectExpr("'k' AS key", "CAST(value AS STRING) AS value", "'telemetry.engine' AS topic")
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_sink(rows, "broker:9092", str(tmp_path), "sink")


def test_capped_reads_lose_no_row_of_one_time(spark, tmp_path):
    df = spark.createDataFrame([(1, i) for i in range(1, 8)] + [(2, 8)], "t int, id long")
    got = files.read_capped(df, "t", ("id",), 0, 2, str(tmp_path / "out"))
    assert sorted(r.id for r in got.collect()) == list(range(1, 9))
    parts = spark.read.parquet(str(tmp_path / "out")).groupBy("part").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    assert {r.part: r.ids for r in parts.collect()} == {0: [1, 2], 1: [3, 4], 2: [5, 6], 3: [7, 8]}


def test_capped_reads_keep_rows_without_a_time_apart(spark, tmp_path):
    df = spark.createDataFrame([(i if i % 5 else None, i) for i in range(50)], "t int, id long")
    got = files.read_capped(df, "t", ("id",), 10, 7, str(tmp_path / "out"))
    assert sorted(r.id for r in got.collect()) == [i for i in range(50) if i % 5 == 0 or i > 10]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out/part=-1")).collect()) == list(range(0, 50, 5))


def test_upserts_of_a_null_key_replace_it(spark):
    from motorpool.sources.tables import unseen, upsert

    old = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    new = spark.createDataFrame([(None, 9), ("b", 3)], "k string, v int")
    assert sorted(((r.k, r.v) for r in upsert(old, new, ["k"]).collect()), key=str) == [("a", 2), ("b", 3), (None, 9)]
    assert [(r.k, r.v) for r in unseen(new, old, ["k"]).collect()] == [("b", 3)]


def test_default_messages(spark):
    cat = spark.createDataFrame([("m", "P1", "non_critical", ["a"], None)], "module string, dtc_code string, severity string, features array<string>, message string")
    got = {r.code: (r.severity, r.message) for r in D.with_messages(spark.createDataFrame([("m", "P1"), ("m", "P2"), ("n", "P1")], "module string, code string").where("module = 'm'"), cat).collect()}
    assert got == {"P1": ("WARNING", "Unknown Warning"), "P2": ("CRITICAL", "Unknown Critical Error")}

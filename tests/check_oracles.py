"""Compare every registered query with its oracle: ``python tests/check_oracles.py [sf] [name-prefix ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402
from motorpool.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v) if v != int(v) or abs(v) > 1e15 else str(int(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got)}", True
    rel = con.execute(sql)
    ocols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if cols != ocols:
        return f"COLUMNS {cols} vs {ocols}", False
    if got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"DIFF rows {len(got)} vs {len(want)} {len(set(got) ^ set(want))} differ e.g. {bad}", False
    return f"ok {len(got)}", True


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in entry.queries():
        if len(sys.argv) > 2 and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        t0 = time.time()
        try:
            msg, ok = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            msg, ok = f"ERROR {type(e).__name__} {str(e)[:600]}", False
        bad += not ok
        print(f"{'  ' if ok else '!!'} {name:40s} {time.time() - t0:6.1f}s {msg}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()

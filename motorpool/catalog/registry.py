"""Named queries with their SQL oracles, and the telemetry views both sides share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.operators.series import Series

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed stand-ins: event type -> telemetry module.
MODULE_OF = {"click": "engine", "view": "transmission", "purchase": "battery", "signup": "body", "error": "tyre"}
TRIP_GAP_HOURS = 24

_MODULE_CASE = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{m}'" for e, m in MODULE_OF.items()) + " END"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_silver": (
        (),
        f"""SELECT event_id, 'sim' || user_id AS source_id, {_MODULE_CASE} AS module, ts, value,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
            least(value / 200.0, 1.0) AS comp, (1.0 - least(value / 200.0, 1.0)) * 100 AS health,
            CASE WHEN least(value / 200.0, 1.0) >= 0.8 THEN 'CRITICAL'
                 WHEN least(value / 200.0, 1.0) >= 0.5 THEN 'WARNING' ELSE 'NORMAL' END AS severity
            FROM events""",
    ),
    "v_feat": (
        ("v_silver",),
        """SELECT event_id, source_id, module, ts, 'f' || ((k + o) % 10) AS feature,
            CASE o WHEN 0 THEN value / 10 WHEN 3 THEN k / 10.0 ELSE value * k / 1000 END AS val, o
            FROM v_silver, (VALUES (0), (3), (7)) AS offs(o)""",
    ),
    "v_bronze": (
        (),
        """SELECT l_suppkey AS source_id, l_returnflag AS module, l_shipdate AS ts, l_orderkey AS okey,
            l_linenumber AS line, l_partkey AS pkey, l_quantity AS qty, l_extendedprice AS price,
            l_discount AS disc, l_tax AS tax FROM lineitem""",
    ),
    "v_fault": (
        ("v_bronze",),
        """SELECT source_id, ts, okey, line, pkey, price, disc, tax, qty / 50.0 AS comp,
            CASE WHEN qty >= 38 THEN 'CRITICAL' WHEN qty >= 28 THEN 'WARNING' ELSE 'NORMAL' END AS severity,
            row_number() OVER (PARTITION BY source_id ORDER BY ts, okey, line, pkey, price) AS rn
            FROM v_bronze""",
    ),
    # Envelopes with one bad row of each kind in twenty (by event_id % 20).
    "v_env": (
        (),
        f"""SELECT *, CASE WHEN b = 8 THEN left(body, length(body) - 9) ELSE body END AS raw FROM (
            SELECT *, '{{"metadata":{{"row_hash":"' || row_hash || '","vehicle_id":"' || vehicle || '","module":"' || module
            || '","source_file":"' || module || '.csv"}},"data":' || data || '}}' AS body FROM (
            SELECT event_id, ts, b, vehicle, 'h' || (CASE WHEN b = 7 THEN event_id - 7 ELSE event_id END) AS row_hash,
            CASE WHEN b = 5 THEN 'hull' ELSE mod0 END AS module,
            '{{"timestamp":"' || stamp || '",' || CASE WHEN b = 4 THEN '"k":' || k || ',"cents":' || cents
              WHEN b = 2 THEN '"cents":' || cents WHEN b = 1 THEN '"cents":"abc","k":' || k
              WHEN b = 3 THEN '"cents":' || cents || ',"k":' || k || ',"spare":1' WHEN b = 6 THEN '"cents":null,"k":' || k
              ELSE '"cents":' || cents || ',"k":' || k END || '}}' AS data, cents, k, stamp FROM (
            SELECT event_id, ts, event_id % 20 AS b, 'sim' || user_id AS vehicle, {_MODULE_CASE} AS mod0,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, CAST(round(value * 100) AS BIGINT) AS cents,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) a) b) c""",
    ),
    "v_log": (
        (),
        """SELECT 'sim' || user_id AS vehicle, event_id, ts, epoch_us(ts) / 1e9 AS t,
            CAST(floor(value) AS BIGINT) % 120 AS speed,
            ((event_id * 7919 + 13) % 1201) / 1000.0 - 0.6 AS ax,
            ((event_id * 104729 + 7) % 1201) / 1000.0 - 0.6 AS ay,
            1.0 + ((event_id * 31337 + 5) % 401 - 200) / 1000.0 AS az,
            28.6 + ((event_id * 7907) % 1000) / 20000.0 AS lat,
            77.2 + ((event_id * 7901) % 1000) / 20000.0 AS lon,
            (200 + (event_id * 53) % 50)::DOUBLE AS alt,
            700 + (event_id * 97) % 3000 AS rpm, (event_id * 89) % 101 AS throttle,
            ((event_id * 17) % 40) / 10.0 AS hdop, (event_id * 19) % 20 AS accuracy FROM events""",
    ),
    "v_trips": (
        ("v_log",),
        f"""SELECT *, t - coalesce(lag(t) OVER (PARTITION BY vehicle, trip ORDER BY ts, event_id), t) AS dt FROM (
            SELECT *, 1 + sum(gap) OVER (PARTITION BY vehicle ORDER BY ts, event_id)::BIGINT AS trip FROM (
            SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY vehicle ORDER BY ts, event_id)
              > {TRIP_GAP_HOURS} * 3600000000 THEN 1 ELSE 0 END AS gap FROM v_log) a) b""",
    ),
}


def with_views(*names: str, body: str, recursive: bool = False) -> str:
    """``WITH`` prefix holding the named views and what they need, then ``body``."""
    order: list[str] = []

    def add(name):
        for need in VIEWS[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        return f"WITH {'RECURSIVE ' if recursive else ''}{ctes},\n{body}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


def query(name: str, sql: str | None = None, views: tuple[str, ...] | list[str] = (), recursive: bool = False):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with an optional oracle."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(*views, body=sql, recursive=recursive) if views else sql.strip()
        return fn

    return register


def r6(c: Column) -> Column:
    return F.round(c, 6)


def r4(c: Column) -> Column:
    return F.round(c, 4)


class Tables:
    """Input tables and telemetry views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def silver(self) -> DataFrame:
        return silver_view(self.events)

    @cached_property
    def feats(self) -> DataFrame:
        return self.silver.select("event_id", "source_id", "module", "ts", F.explode("features").alias("feature", "val"))

    @cached_property
    def bronze(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_suppkey").alias("source_id"), F.col("l_returnflag").alias("module"),
            F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_orderkey").alias("okey"),
            F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("pkey"), F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
        )

    @cached_property
    def envelopes(self) -> DataFrame:
        return envelope_view(self.events)

    BRONZE_ORDER = ("ts", "okey", "line", "pkey", "price")

    def bronze_series(self, *columns: str, keys=("source_id",)) -> Series:
        keep = [*keys, *self.BRONZE_ORDER, *[c for c in columns if c not in (*keys, *self.BRONZE_ORDER)]]
        return Series(self.bronze.select(*keep), keys, self.BRONZE_ORDER)

    @cached_property
    def fault(self) -> DataFrame:
        q = F.col("qty")
        sev = F.when(q >= 38, "CRITICAL").when(q >= 28, "WARNING").otherwise("NORMAL")
        return self.bronze.select(
            "source_id", *self.BRONZE_ORDER, "disc", "tax", (q / 50.0).alias("comp"), sev.alias("severity")
        )

    @cached_property
    def log(self) -> DataFrame:
        """Driving log; its clock ``t`` runs 1000 times faster than the event time."""
        i, d = F.col("event_id"), lambda c, n: c / F.lit(float(n))
        return self.events.select(
            F.concat(F.lit("sim"), "user_id").alias("vehicle"), "event_id", "ts",
            d(F.unix_micros("ts"), 1e9).alias("t"), (F.floor("value") % 120).alias("speed"),
            (d((i * 7919 + 13) % 1201, 1000) - 0.6).alias("ax"), (d((i * 104729 + 7) % 1201, 1000) - 0.6).alias("ay"),
            (1.0 + d((i * 31337 + 5) % 401 - 200, 1000)).alias("az"),
            (28.6 + d((i * 7907) % 1000, 20000)).alias("lat"), (77.2 + d((i * 7901) % 1000, 20000)).alias("lon"),
            (200.0 + (i * 53) % 50).alias("alt"), (700 + (i * 97) % 3000).alias("rpm"), ((i * 89) % 101).alias("throttle"),
            d((i * 17) % 40, 10).alias("hdop"), ((i * 19) % 20).alias("accuracy"),
        )

    def log_series(self) -> Series:
        return Series(self.log, ["vehicle"], ["ts", "event_id"])

    def trip_series(self) -> Series:
        from motorpool.plans.trips import number_trips, trip_deltas

        trips = number_trips(self.log_series(), "ts", TRIP_GAP_HOURS)
        return trip_deltas(trips, dt=("t", None))


def envelope_view(events: DataFrame) -> DataFrame:
    """JSON envelopes with seeded bad rows (wrong type, missing, extra, swapped, unknown module, NULL,
    repeated hash, cut-off JSON), by ``event_id % 20``."""
    module = F.element_at(F.create_map(*[F.lit(v) for kv in MODULE_OF.items() for v in kv]), F.col("event_type"))
    i, b, cat = F.col("event_id"), F.col("b"), lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    cents, k = cat('"cents":', F.col("cents")), cat('"k":', F.col("k"))
    fields = (
        F.when(b == 4, cat(k, ",", cents)).when(b == 2, cents).when(b == 1, cat('"cents":"abc",', k))
        .when(b == 3, cat(cents, ",", k, ',"spare":1')).when(b == 6, cat('"cents":null,', k)).otherwise(cat(cents, ",", k))
    )
    df = events.select(
        "event_id", "ts", (i % 20).alias("b"), F.concat(F.lit("sim"), "user_id").alias("vehicle"), module.alias("_m"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    df = df.withColumns({
        "row_hash": cat("h", F.when(b == 7, i - 7).otherwise(i)), "module": F.when(b == 5, "hull").otherwise(F.col("_m")),
        "data": cat('{"timestamp":"', F.col("stamp"), '",', fields, "}"),
    })
    body = cat(
        '{"metadata":{"row_hash":"', F.col("row_hash"), '","vehicle_id":"', F.col("vehicle"), '","module":"', F.col("module"),
        '","source_file":"', F.col("module"), '.csv"},"data":', F.col("data"), "}",
    )
    df = df.withColumn("body", body)
    return df.withColumn("raw", F.when(b == 8, F.expr("left(body, length(body) - 9)")).otherwise(F.col("body"))).drop("_m")


def silver_view(events: DataFrame) -> DataFrame:
    """Scored rows derived from the events table; works on batches and streams."""
    module = F.element_at(F.create_map(*[F.lit(v) for kv in MODULE_OF.items() for v in kv]), F.col("event_type"))
    comp = F.least(F.col("value") / 200.0, F.lit(1.0))
    k, v = F.col("k"), F.col("value")
    name = lambda o: F.concat(F.lit("f"), (k + o) % 10)
    feats = F.map_from_arrays(F.array(name(0), name(3), name(7)), F.array(v / 10, k / F.lit(10.0), v * k / 1000))
    return (
        events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
        .select(
            "event_id", F.concat(F.lit("sim"), "user_id").alias("source_id"), module.alias("module"), "ts", "value", "k",
            comp.alias("comp"), ((1.0 - comp) * 100).alias("health"),
            F.when(comp >= 0.8, "CRITICAL").when(comp >= 0.5, "WARNING").otherwise("NORMAL").alias("severity"),
            feats.alias("features"),
        )
    )

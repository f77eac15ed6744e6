"""Driver-behaviour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from motorpool.catalog.registry import Tables, query, r4, r6
from motorpool.functions import scoring
from motorpool.operators.quantiles import exact_percentiles
from motorpool.plans import trips as T

_PREV = "OVER (PARTITION BY vehicle, trip ORDER BY ts, event_id)"
_SEG = f"seg AS (SELECT *, sum(CASE WHEN dt > 30 THEN 1 ELSE 0 END) {_PREV}::BIGINT AS segment, speed * (5.0 / 18.0) * dt AS dist FROM v_trips)"


@query(
    "w1_trip_deltas", views=["v_trips"],
    sql="""SELECT event_id, trip, round(dt, 6) AS dt,
        speed - coalesce(lag(speed) OVER w, speed) AS dv, alt - coalesce(lag(alt) OVER w, alt) AS dalt,
        rpm - coalesce(lag(rpm) OVER w, rpm) AS drpm
        FROM v_trips WINDOW w AS (PARTITION BY vehicle, trip ORDER BY ts, event_id)""",
)
def _(t: Tables):
    s = T.number_trips(t.log_series(), "ts", 24)
    s = T.trip_deltas(s, dt=("t", None), dv=("speed", None), dalt=("alt", None), drpm=("rpm", None))
    return s.result().select("event_id", "trip", r6(F.col("dt")).alias("dt"), "dv", "dalt", "drpm")


@query(
    "w2_sessionise_by_gap",
    sql="""SELECT event_id, user_id, 1 + sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS trip FROM (
        SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
        > 8 * 3600000000 THEN 1 ELSE 0 END AS g FROM events)""",
)
def _(t: Tables):
    from motorpool.operators.series import Series

    log = Series(t.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return T.number_trips(log, "ts", 8).result().select("event_id", "user_id", "trip")


@query(
    "w2_sessionise_whole_log",
    sql="""SELECT event_id, 1 + sum(g) OVER (ORDER BY ts, event_id)::BIGINT AS trip FROM (
        SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id) > 720000000 THEN 1 ELSE 0 END AS g FROM events)""",
)
def _(t: Tables):
    """One session numbering over the whole log: a single series, cut into chunks once it is large."""
    from motorpool.operators.series import Series

    log = Series(t.events.select(F.lit(0).alias("log"), "ts", "event_id"), ["log"], ["ts", "event_id"])
    return T.number_trips(log, "ts", 0.2).result().select("event_id", "trip")


@query("w3_trip_segments", views=["v_trips"], sql=f"WITH {_SEG} SELECT event_id, trip, segment FROM seg")
def _(t: Tables):
    return T.segments(t.trip_series()).result().select("event_id", "trip", "segment")


_CUM = f"""cum AS (SELECT *, sum(dist) {_PREV} AS cum,
    sum(dist) OVER (PARTITION BY vehicle, trip ORDER BY ts DESC, event_id DESC) AS rev FROM seg)"""


@query(
    "w4_distance_privacy_trim", views=["v_trips"],
    sql=f"""WITH {_SEG}, {_CUM} SELECT event_id, trip, round(dist, 4) AS dist, round(cum, 4) AS cum, round(rev, 4) AS rev
        FROM cum WHERE cum > 1000 AND rev > 1000""",
)
def _(t: Tables):
    s = T.with_distance(t.trip_series())
    return T.privacy_trim(s).select("event_id", "trip", *[r4(F.col(c)).alias(c) for c in ("dist", "cum", "rev")])


@query(
    "w6_centred_rolling_median", views=["v_trips"],
    sql="""SELECT event_id, quantile_cont(alt, 0.5) OVER (PARTITION BY vehicle, trip ORDER BY ts, event_id
        ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS smooth_alt FROM v_trips""",
)
def _(t: Tables):
    s = t.trip_series()
    s = s.rekey([*s.keys, "trip"]).rolling(5, 4, smooth_alt=lambda w: F.percentile("alt", F.lit(0.5)).over(w))
    return s.result().select("event_id", "smooth_alt")


_GRADE = f"""grade AS (SELECT *, CASE WHEN dist = 0 THEN 0.0 ELSE atan2(d_alt, dist) END AS grade FROM (
    SELECT *, smooth_alt - coalesce(lag(smooth_alt) OVER (PARTITION BY vehicle, trip, segment ORDER BY ts, event_id), smooth_alt) AS d_alt
    FROM (SELECT *, quantile_cont(alt, 0.5) OVER (PARTITION BY vehicle, trip ORDER BY ts, event_id
        ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) AS smooth_alt FROM seg) a) b)"""
_HEAD = """head AS (SELECT *, coalesce(((degrees(atan2(sin(radians(lon) - radians(plon)) * cos(radians(lat)),
    cos(radians(plat)) * sin(radians(lat)) - sin(radians(plat)) * cos(radians(lat)) * cos(radians(lon) - radians(plon)))) % 360) + 360) % 360, 0.0) AS heading
    FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM {src} WINDOW w AS (PARTITION BY vehicle ORDER BY ts, event_id)) a)"""
_YAW = """yaw AS (SELECT *, CASE WHEN dt = 0 THEN 0.0 ELSE abs((((turn + 180) % 360) + 360) % 360 - 180) / dt END AS yaw FROM (
    SELECT *, heading - coalesce(lag(heading) OVER (PARTITION BY vehicle, trip, segment ORDER BY ts, event_id), heading) AS turn FROM head) a)"""


@query("w21_road_grade", views=["v_trips"], sql=f"WITH {_SEG}, {_GRADE} SELECT event_id, smooth_alt, round(grade, 6) AS grade FROM grade")
def _(t: Tables):
    s = T.grade(T.with_distance(T.segments(t.trip_series())))
    return s.result().select("event_id", "smooth_alt", r6(F.col("grade")).alias("grade"))


@query("p19_bearing", views=["v_trips"], sql=f"WITH {_HEAD.format(src='v_trips')} SELECT event_id, round(heading, 4) AS heading FROM head")
def _(t: Tables):
    return T.heading(t.log_series()).result().select("event_id", r4(F.col("heading")).alias("heading"))


@query(
    "w20_yaw_rate", views=["v_trips"],
    sql=f"WITH {_SEG}, {_HEAD.format(src='seg')}, {_YAW} SELECT event_id, round(yaw, 4) AS yaw FROM yaw",
)
def _(t: Tables):
    s = T.yaw_rate(T.heading(T.segments(t.trip_series())))
    return s.result().select("event_id", r4(F.col("yaw")).alias("yaw"))


_LEVEL = """lev AS (SELECT *, cos(pitch) * ax - sin(pitch) * (cos(roll) * az - sin(roll) * ay) AS ax_cal,
    cos(roll) * ay + sin(roll) * az AS ay_cal,
    sin(pitch) * ax + cos(pitch) * (cos(roll) * az - sin(roll) * ay) AS az_cal FROM (
    SELECT *, atan2(-mx, sqrt(my * my + mz * mz)) AS pitch, atan2(my, sqrt(mx * mx + mz * mz)) AS roll FROM (
    SELECT s.*, coalesce(m.mx, 0.0) AS mx, coalesce(m.my, 0.0) AS my, coalesce(m.mz, 1.0) AS mz FROM {src} s
    LEFT JOIN (SELECT vehicle, trip, median(ax) AS mx, median(ay) AS my, median(az) AS mz
        FROM v_trips WHERE speed = 0 GROUP BY ALL) m USING (vehicle, trip)) a) b)"""


@query(
    "p20_levelled_acceleration", views=["v_trips"],
    sql=f"""WITH {_LEVEL.format(src='v_trips')} SELECT event_id, round(ax_cal, 6) AS ax_cal, round(ay_cal, 6) AS ay_cal,
        round(az_cal, 6) AS az_cal FROM lev""",
)
def _(t: Tables):
    df = T.level(t.trip_series()).result()
    return df.select("event_id", *[r6(F.col(c)).alias(c) for c in ("ax_cal", "ay_cal", "az_cal")])


@query(
    "p21_harsh_events_basic", views=["v_trips"],
    sql=f"""WITH {_LEVEL.format(src='v_trips')} SELECT event_id, ax_cal < -0.4 AND throttle < 5 AS braking,
        ax_cal > 0.3 AND throttle > 60 AND drpm > 0 AS accel, abs(ay_cal) > 0.4 AND speed > 30 AS cornering
        FROM (SELECT *, rpm - coalesce(lag(rpm) OVER (PARTITION BY vehicle, trip ORDER BY ts, event_id), rpm) AS drpm FROM lev)""",
)
def _(t: Tables):
    s = T.trip_deltas(T.level(t.trip_series()), d_rpm=("rpm", None))
    return s.result().select("event_id", *[c.alias(n) for n, c in T.harsh_events_basic().items()])


@query(
    "p22_gps_validity", views=["v_log"],
    sql="SELECT event_id, hdop, accuracy FROM v_log WHERE hdop <= 2.0 AND accuracy < 10",
)
def _(t: Tables):
    return t.log.filter((F.col("hdop") <= 2.0) & (F.col("accuracy") < 10.0)).select("event_id", "hdop", "accuracy")


_IDLE = f"""isl AS (SELECT *, sum(ch) {_PREV}::BIGINT AS island FROM (
    SELECT *, CASE WHEN lag(idling) {_PREV} IS DISTINCT FROM idling THEN 1 ELSE 0 END AS ch FROM (
    SELECT *, speed < 20 AND rpm > 1000 AS idling FROM v_trips) a) b)"""


def _idle(t: Tables):
    return T.idle_islands(t.trip_series(), (F.col("speed") < 20) & (F.col("rpm") > 1000))


@query("w23_idle_islands", views=["v_trips"], sql=f"WITH {_IDLE} SELECT event_id, idling, island FROM isl")
def _(t: Tables):
    return _idle(t).result().select("event_id", "idling", "island")


@query(
    "a28_idle_durations", views=["v_trips"],
    sql=f"""WITH {_IDLE} SELECT vehicle, trip, island, count(*) * 4.0::DOUBLE AS seconds, count(*) * 4 > 12 AS excessive
        FROM isl WHERE idling GROUP BY ALL""",
)
def _(t: Tables):
    return T.idle_durations(_idle(t), limit=12.0)


# Roads come from the suppliers: one three-point line each, classed by nation.
_ROADS = """roads AS (SELECT s_suppkey AS road_id, CASE s_nationkey % 4 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary'
    WHEN 2 THEN 'residential' ELSE 'service' END AS fclass, p AS seq,
    77.19 + ((s_suppkey * 37 + p * 11) % 700) / 10000.0 AS lon, 28.59 + ((s_suppkey * 53 + p * 17) % 700) / 10000.0 AS lat
    FROM supplier, (VALUES (0), (1), (2)) AS pts(p))"""
_NEAR = f"""{_ROADS}, rs AS (SELECT road_id, fclass, lon AS x1, lat AS y1, lead(lon) OVER w AS x2, lead(lat) OVER w AS y2
    FROM roads WHERE road_id IN (SELECT road_id FROM roads, (SELECT min(lon) - 0.01 AS a, max(lon) + 0.01 AS b, min(lat) - 0.01 AS c, max(lat) + 0.01 AS d FROM v_log) AS box
      GROUP BY road_id HAVING max(lon) >= min(a) AND min(lon) <= min(b) AND max(lat) >= min(c) AND min(lat) <= min(d))
    WINDOW w AS (PARTITION BY road_id ORDER BY seq)),
    spots AS (SELECT DISTINCT lon, lat FROM v_log),
    pd AS (SELECT lon, lat, road_id, fclass, min(sqrt(power(lon - (x1 + u * (x2 - x1)), 2) + power(lat - (y1 + u * (y2 - y1)), 2))) AS d FROM (
      SELECT *, least(greatest(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / (power(x2 - x1, 2) + power(y2 - y1, 2)), 0.0), 1.0) AS u
      FROM spots, rs WHERE x2 IS NOT NULL) z GROUP BY ALL),
    near AS (SELECT lon, lat, min(d) AS d FROM pd GROUP BY ALL)"""


def _roads(t: Tables):
    k = F.col("s_suppkey")
    kind = F.element_at(F.array(*map(F.lit, ("motorway", "primary", "residential", "service"))), F.col("s_nationkey") % 4 + 1)
    pts = t.table("supplier").withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return pts.select(
        k.alias("road_id"), kind.alias("fclass"), "seq",
        (77.19 + ((k * 37 + F.col("seq") * 11) % 700) / F.lit(10000.0)).alias("lon"),
        (28.59 + ((k * 53 + F.col("seq") * 17) % 700) / F.lit(10000.0)).alias("lat"),
    )


@query(
    "j4_nearest_road", views=["v_log"],
    sql=f"""WITH {_NEAR} SELECT event_id, coalesce(min(fclass), 'unknown') AS road_type, count(pd.road_id) AS ties,
        round(min(pd.d), 6) AS road_dist FROM v_log LEFT JOIN near USING (lon, lat)
        LEFT JOIN pd ON pd.lon = v_log.lon AND pd.lat = v_log.lat AND abs(pd.d - near.d) < 1e-12 GROUP BY event_id""",
)
def _(t: Tables):
    near = T.nearest_road(t.log, _roads(t), ["event_id"])
    return near.groupBy("event_id").agg(
        F.min("road_type").alias("road_type"), F.count("road_id").alias("ties"), r6(F.min("road_dist")).alias("road_dist")
    )


@query(
    "a18_speed_by_road_type", views=["v_log"],
    sql=f"""WITH {_NEAR} SELECT road_type, min(speed)::DOUBLE AS lowest, quantile_cont(speed, 0.25) AS q1, quantile_cont(speed, 0.5) AS q2,
        quantile_cont(speed, 0.75) AS q3, max(speed)::DOUBLE AS highest, round(avg(speed), 6) AS mean FROM (
        SELECT event_id, speed::DOUBLE AS speed, coalesce(min(fclass), 'unknown') AS road_type FROM v_log LEFT JOIN near USING (lon, lat)
        LEFT JOIN pd ON pd.lon = v_log.lon AND pd.lat = v_log.lat AND abs(pd.d - near.d) < 1e-12 GROUP BY event_id, speed) GROUP BY road_type""",
)
def _(t: Tables):
    near = T.nearest_road_type(t.log, _roads(t), ["event_id"]).groupBy("event_id").agg(F.min("road_type").alias("road_type"))
    df = t.log.select("event_id", F.col("speed").cast("double").alias("speed")).join(near, "event_id")
    q = exact_percentiles(df, ["road_type"], "speed", {"lowest": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "highest": 1.0})
    return q.join(df.groupBy("road_type").agg(r6(F.avg("speed")).alias("mean")), "road_type")


def road_aware_events(t: Tables):
    s = T.yaw_rate(T.heading(T.grade(T.with_distance(T.segments(T.level(t.trip_series()))))))
    s = T.trip_deltas(s, ("trip", "segment"), dv=("speed", None))
    s = s.with_df(s.df.withColumn("ax_true", F.col("ax_cal") + F.sin("grade")))
    near = T.nearest_road_type(t.log, _roads(t), ["event_id"]).groupBy("event_id").agg(F.min("road_type").alias("road_type"))
    s = s.with_df(s.df.join(near, "event_id", "left"))
    return s.with_df(s.df.withColumns(T.harsh_events(F.coalesce("road_type", F.lit("unknown")))))


_EVENTS = f"""{_NEAR}, cls AS (SELECT event_id, coalesce(min(fclass), 'unknown') AS road FROM v_log LEFT JOIN near USING (lon, lat)
    LEFT JOIN pd ON pd.lon = v_log.lon AND pd.lat = v_log.lat AND abs(pd.d - near.d) < 1e-12 GROUP BY event_id),
    {_SEG}, {_LEVEL.format(src='seg')},
    {_GRADE.replace('FROM seg', 'FROM lev')}, {_HEAD.format(src='grade')}, {_YAW},
    ev AS (SELECT *, ax_true < -0.35 AS braking, ax_true > 0.25 AND dv > 0 AS accel,
      abs(ay_cal) > (CASE WHEN road IN ('motorway', 'primary') AND yaw < 5 THEN 0.25 ELSE 0.45 END) AND speed > 20 AS cornering FROM (
      SELECT *, ax_cal + sin(grade) AS ax_true,
      speed - coalesce(lag(speed) OVER (PARTITION BY vehicle, trip, segment ORDER BY ts, event_id), speed) AS dv FROM yaw LEFT JOIN cls USING (event_id)) q)"""


@query(
    "p21_harsh_events_road_aware", views=["v_trips", "v_log"],
    sql=f"WITH {_EVENTS} SELECT event_id, braking, accel, cornering FROM ev",
)
def _(t: Tables):
    return road_aware_events(t).result().select("event_id", "braking", "accel", "cornering")


@query(
    "p14_event_label", views=["v_trips", "v_log"],
    sql=f"""WITH {_EVENTS} SELECT event_id, CASE WHEN braking THEN 'Harsh Braking' WHEN accel THEN 'Harsh Accel'
        WHEN cornering THEN 'Harsh Cornering' ELSE 'Normal' END AS label FROM ev""",
)
def _(t: Tables):
    df = road_aware_events(t).result()
    return df.select("event_id", scoring.event_label(F.col("braking"), F.col("accel"), F.col("cornering")).alias("label"))


@query(
    "a17_events_per_100km", views=["v_trips", "v_log"],
    sql=f"""WITH {_EVENTS} SELECT vehicle, {", ".join(
        f"round(CASE WHEN sum(dist) > 0 THEN count(*) FILTER ({c}) / (sum(dist) / 1000.0) * 100 ELSE 0.0 END, 4) AS {c}_rate"
        for c in ("braking", "accel", "cornering"))} FROM ev GROUP BY vehicle""",
)
def _(t: Tables):
    out = T.events_per_100km(road_aware_events(t).result(), ["vehicle"])
    return out.select("vehicle", *[r4(F.col(f"{c}_rate")).alias(f"{c}_rate") for c in ("braking", "accel", "cornering")])


@query(
    "w22_driver_score", views=["v_trips", "v_log"], recursive=True,
    sql=f"""WITH {_EVENTS},
    o AS MATERIALIZED (SELECT vehicle, event_id, dist, 5 * braking::INT + 3 * accel::INT + 5 * cornering::INT AS hit,
        row_number() OVER (PARTITION BY vehicle ORDER BY ts, event_id) AS rn FROM ev),
    f AS (SELECT vehicle, 0::BIGINT AS rn, 0::BIGINT AS event_id, 100.0::DOUBLE AS score, 0.0::DOUBLE AS clean FROM o WHERE rn = 1
      UNION ALL SELECT o.vehicle, o.rn, o.event_id,
        least(100.0, greatest(0.0, CASE WHEN hit > 0 THEN score - hit WHEN clean + dist >= 250 THEN score + 1 ELSE score END)),
        CASE WHEN hit > 0 THEN 0.0 WHEN clean + dist >= 250 THEN clean + dist - 250 ELSE clean + dist END
      FROM f JOIN o ON o.vehicle = f.vehicle AND o.rn = f.rn + 1)
    SELECT event_id, score FROM f WHERE rn > 0""",
)
def _(t: Tables):
    return T.driver_score(road_aware_events(t)).result().select("event_id", "score")

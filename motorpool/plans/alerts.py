"""Alert episodes from a leaky-bucket score, and the look-back from an alert into bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.functions.keys import null_safe_join
from motorpool.functions.numeric import round_py
from motorpool.functions.scoring import SCORE_MAX, SCORE_MIN, score_delta
from motorpool.operators.fold import Clamp, clamp_inputs
from motorpool.operators.series import BROADCAST_ROWS, Series, run_sum
from motorpool.session import cut

TOP_FEATURES = 10
LOOKBACK_ROWS = 600


def scored(rows: Series) -> Series:
    """Bucket score after each row, from ``severity``."""
    return rows.fold("score", Clamp(), F.lit(0.0), **clamp_inputs(score_delta(F.col("severity")), SCORE_MIN, SCORE_MAX))


def excursions(rows: Series) -> Series:
    """``score`` plus the number of earlier rows at score 0: rows between two empties share it."""
    s = scored(rows)
    empty = (F.col("score") <= SCORE_MIN).cast("long")
    s = s.running(excursion=run_sum(empty))
    return s.with_df(s.df.withColumn("excursion", F.col("excursion") - empty))


def episodes(rows: Series, features: str | None = None) -> DataFrame:
    """Every excursion that fills the bucket is one alert.

    Only the score needs row order; the rest are aggregates per excursion, combined before
    their shuffle. ``rows`` holds ``severity``, ``comp`` and optionally a JSON feature map.
    """
    return summarise_excursions(excursions(rows), features)


def summarise_excursions(s: Series, features: str | None = None) -> DataFrame:
    df, keys, ts = s.result(), s.keys, s.order[0]
    live = F.col("score") > SCORE_MIN
    peak_rank = F.when(live & (F.col("comp") > 0), F.struct((-F.col("comp")).alias("c"), *s.order))
    per = df.groupBy(*keys, "excursion").agg(
        F.max("score").alias("_top"), F.min(F.when(live, F.col(ts))).alias("alert_start_ts"),
        F.max(F.when(~live, F.col(ts))).alias("alert_end_ts"), F.min(peak_rank).alias("_peak"),
    ).filter(F.col("_top") >= SCORE_MAX)
    out = per.select(
        *keys, "excursion", alert_id(keys, ts="alert_start_ts").alias("alert_id"),
        F.when(F.col("alert_end_ts").isNull(), "OPEN").otherwise("CLOSED").alias("status"),
        "alert_start_ts", "alert_end_ts", F.col(f"_peak.{ts}").alias("peak_anomaly_ts"),
        round_py(F.coalesce(-F.col("_peak.c"), F.lit(0.0)), 4).alias("max_composite_score"),
    )
    if features is None:
        return out
    sums = feature_sums(df.filter(live), [*keys, "excursion"], features)
    w = Window.partitionBy(*keys, "excursion").orderBy(F.desc("total"), "feature")
    top = sums.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= TOP_FEATURES)
    maps = top.groupBy(*keys, "excursion").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", round_py(F.col("total"), 4)))).alias("top_10_features")
    )
    return null_safe_join(out, maps, [*keys, "excursion"], "left")


def alert_id(keys: list[str], ts: str) -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col(ts).cast("string"), F.col("excursion").cast("string")), 256)


def feature_sums(df: DataFrame, keys: list[str], features: str) -> DataFrame:
    """Sum per feature of JSON maps; unreadable maps count as empty."""
    entries = F.coalesce(F.from_json(features, "map<string,double>"), F.create_map().cast("map<string,double>"))
    return df.select(*keys, F.explode(entries).alias("feature", "v")).groupBy(*keys, "feature").agg(F.sum("v").alias("total"))


def episodes_by_fold(rows: Series) -> DataFrame:
    """The same alerts straight from the state machine, as a table function over ordered rows.

    A second path for checking, which holds a key's rows in one array; where a key exceeds the
    series' row target, the chunked form gives the same alerts.
    """
    if rows.hot:
        kept = [*rows.keys, "status", "alert_start_ts", "alert_end_ts", "peak_anomaly_ts", "max_composite_score"]
        return episodes(rows).select(*kept)
    ts = rows.order[0]
    row = F.struct(*rows.order, "severity", "comp")
    hist = rows.df.groupBy(*rows.keys).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    when = rows.df.schema[ts].dataType
    none = F.lit(None).cast(when)
    blank = lambda: F.struct(none.alias("start"), none.alias("end"), none.alias("peak"), F.lit(0.0).alias("top"))
    kind = f"array<struct<start:{when.simpleString()},end:{when.simpleString()},peak:{when.simpleString()},top:double>>"
    empty = F.array().cast(kind)
    start = F.struct(F.lit(0.0).alias("score"), F.lit(False).alias("active"), blank().alias("cur"), empty.alias("done"))

    def step(acc, r):
        score = F.least(F.lit(SCORE_MAX), F.greatest(F.lit(SCORE_MIN), acc["score"] + score_delta(r["severity"])))
        live, cur = score > SCORE_MIN, acc["cur"]
        better = r["comp"] > cur["top"]
        tracked = F.struct(
            F.coalesce(cur["start"], r[ts]).alias("start"), none.alias("end"),
            F.when(better, r[ts]).otherwise(cur["peak"]).alias("peak"), F.when(better, r["comp"]).otherwise(cur["top"]).alias("top"),
        )
        closed = F.struct(cur["start"], r[ts].alias("end"), cur["peak"], cur["top"])
        return F.struct(
            score.alias("score"), (live & (acc["active"] | (score >= SCORE_MAX))).alias("active"),
            F.when(live, tracked).otherwise(blank()).alias("cur"),
            F.when(acc["active"] & ~live, F.concat(acc["done"], F.array(closed))).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc):
        return F.when(acc["active"], F.concat(acc["done"], F.array(acc["cur"]))).otherwise(acc["done"])

    found = hist.select(*rows.keys, F.explode(F.aggregate("_rows", start, step, finish)).alias("e"))
    return found.select(
        *rows.keys, F.when(F.col("e.end").isNull(), "OPEN").otherwise("CLOSED").alias("status"),
        F.col("e.start").alias("alert_start_ts"), F.col("e.end").alias("alert_end_ts"), F.col("e.peak").alias("peak_anomaly_ts"),
        round_py(F.col("e.top"), 4).alias("max_composite_score"),
    )


def alert_matrix(alerts: DataFrame, source: str, module: str, modules: list) -> DataFrame:
    """Alerts per vehicle and module with a total row; the totals come from grouping sets."""
    per = alerts.groupBy(source, module).agg(F.count("*").alias("n"))
    label = F.when(F.grouping(source) == 1, F.lit("TOTAL_BY_MODULE")).otherwise(F.col(source).cast("string"))
    cols = [F.coalesce(F.sum(F.when(F.col(module) == m, F.col("n"))), F.lit(0)).alias(str(m)) for m in modules]
    return per.rollup(source).agg(label.alias("vehicle"), *cols, F.coalesce(F.sum("n"), F.lit(0)).alias("total")).drop(source)


def traceback(alerts: DataFrame, bronze: DataFrame, key: str, alert: str, peak: str, order: list[str], rows: int = LOOKBACK_ROWS,
              target_rows: int | None = None) -> DataFrame:
    """For many alerts at once, the last ``rows`` bronze rows of the vehicle up to the peak.

    Bronze rows get a dense position per vehicle. An alert's end position is the number of
    bronze rows up to its peak, counted in the same ordered pass by mixing the alerts into
    the series. The wanted positions then cover two blocks of ``rows`` positions at most, so
    the join is an equi-join on (vehicle, block) instead of a range join.
    """
    ts, kw = order[0], {"target_rows": target_rows} if target_rows else {}
    kinds = {c: bronze.schema[c].dataType for c in order}
    # Alerts are used three times; written once, they are also cheap to count.
    alerts = cut(alerts.select(key, alert, peak))
    vehicles = alerts.select(key).distinct()
    bronze = null_safe_join(bronze, vehicles, [key], "left_semi", small=vehicles.count() <= BROADCAST_ROWS)
    marks = alerts.select(
        key, F.col(peak).cast(kinds[ts]).alias(ts), *[F.lit(None).cast(kinds[c]).alias(c) for c in order[1:]],
        F.lit(1).alias("_mark"), F.col(alert).cast("string").alias("_alert"),
    )
    lines = bronze.select(key, *order, F.lit(0).alias("_mark"), F.lit(None).cast("string").alias("_alert"))
    mixed = Series(lines.unionByName(marks), [key], [ts, "_mark", *order[1:], "_alert"], **kw)
    ends = mixed.running(_end=run_sum((F.col("_mark") == 0).cast("long"))).result()
    ends = ends.filter("_mark = 1").select(key, F.col("_alert").alias(alert), "_end")
    spans = ends.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.greatest(F.col("_end") - rows, F.lit(0)) / rows), F.floor(F.greatest(F.col("_end") - 1, F.lit(0)) / rows)))
    )
    placed = Series(bronze, [key], order, **kw).indexed("_pos").result().withColumn("_block", F.floor(F.col("_pos") / rows))
    few = 2 * alerts.count() <= BROADCAST_ROWS
    hit = null_safe_join(placed, spans, [key, "_block"], small=few).filter((F.col("_pos") < F.col("_end")) & (F.col("_pos") >= F.col("_end") - rows))
    return hit.withColumn("pos", F.col("_pos") - F.greatest(F.col("_end") - rows, F.lit(0))).drop("_block", "_pos", "_end")


def live_split(alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open alerts by peak, closed ones by end, newest first."""
    return (
        alerts.filter("status = 'OPEN'").orderBy(F.desc("peak_anomaly_ts"), "alert_id"),
        alerts.filter("status = 'CLOSED'").orderBy(F.desc("alert_end_ts"), "alert_id"),
    )

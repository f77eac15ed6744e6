"""Fault-code scoring and attribution over look-back slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the attribution rules.
TRIGGER_RISK = 0.99
MIN_EVIDENCE = 1e-6
NOISE_FLOOR, SENSITIVITY = 0.15, 0.001
DEFAULT_TEXT = {"critical": "Unknown Critical Error", "non_critical": "Unknown Warning"}
SEVERITY_TEXT = {"critical": "CRITICAL", "non_critical": "WARNING"}


def score_codes(rows: DataFrame, models: list[dict]) -> DataFrame:
    """One probability column per code whose features are all present.

    ``models`` holds a few parameters per code (``code``, ``features``, ``lo``, ``hi``, ``coef``,
    ``intercept``), so they go into the plan as literals and scoring stays in generated code.
    """
    cols = {}
    for m in models:
        if not set(m["features"]) <= set(rows.columns):
            continue
        z = F.lit(float(m["intercept"]))
        for f, lo, hi, b in zip(m["features"], m["lo"], m["hi"], m["coef"]):
            z = z + F.lit(float(b)) * (F.col(f) - F.lit(float(lo))) / F.lit(float(hi - lo) if hi != lo else 1.0)
        cols[m["code"]] = 1.0 / (1.0 + F.exp(-z))
    return rows.withColumns(cols)


def long_codes(rows: DataFrame, ids: list[str], codes: list[str]) -> DataFrame:
    """Wide probability columns to (ids, code, p)."""
    return rows.unpivot(ids, codes, "code", "p")


def accumulate(order, p: Column, floor: float = NOISE_FLOOR, sensitivity: float = SENSITIVITY) -> Column:
    """Running evidence above a noise floor, full at 1."""
    w = order.rowsBetween(Window.unboundedPreceding, 0)
    return F.least(F.sum(F.greatest(p - floor, F.lit(0.0))).over(w) * sensitivity, F.lit(1.0))


def attribute(long: DataFrame, slice_key: str, pos: str = "pos") -> DataFrame:
    """Risk per code and row: squared evidence above the code's median, summed up, scaled so that
    the strongest code of the slice ends at 1. Slices hold a fixed number of rows at most."""
    per_code = Window.partitionBy(slice_key, "code")
    ordered = per_code.orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    floor = F.percentile("p", F.lit(0.5)).over(per_code)
    df = long.withColumn("_floor", floor).withColumn("_e", F.pow(F.greatest(F.col("p") - F.col("_floor"), F.lit(0.0)), F.lit(2.0)))
    df = df.withColumn("_b", F.sum("_e").over(ordered))
    peak = F.max("_b").over(Window.partitionBy(slice_key))
    scale = F.when(peak > MIN_EVIDENCE, 1.0 / peak).otherwise(0.0)
    return df.withColumn("risk", F.least(F.col("_b") * scale, F.lit(1.0))).drop("_floor", "_e", "_b")


def triggers(attributed: DataFrame, catalog: DataFrame, slice_key: str, module: str) -> DataFrame:
    """Codes of a module whose risk reaches the trigger, with severity and message (defaults per severity)."""
    top = attributed.groupBy(slice_key, "code").agg(F.max("risk").alias("risk")).filter(F.col("risk") >= TRIGGER_RISK)
    top = top.withColumn("module", F.lit(module))
    return with_messages(top, catalog).select(slice_key, "code", "severity", "message")


def with_messages(codes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Equi lookup by (module, code) in the fault catalogue, which is a fixed contract of a few dozen rows.

    A code may stand in several modules with different texts.
    """
    cat = F.broadcast(catalog.select("module", F.col("dtc_code").alias("code"), F.col("severity").alias("_s"), F.col("message").alias("_t")))
    pick = lambda table: F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), F.coalesce("_s", F.lit("critical")))
    return codes.join(cat, ["module", "code"], "left").withColumns(
        {"severity": pick(SEVERITY_TEXT), "message": F.coalesce("_t", pick(DEFAULT_TEXT))}
    ).drop("_s", "_t")


def magnify(long: DataFrame, value: str = "p") -> DataFrame:
    """Min-max over all codes together; flat data (range under 1e-9) is left alone."""
    edge = long.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    span = edge["hi"] - edge["lo"]
    return long.withColumn(value, F.when(span < 1e-9, F.col(value)).otherwise((F.col(value) - edge["lo"]) / span))

"""Validation of raw rows and envelopes against the contract, in one pass without a shuffle."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.contract import DTYPES, METADATA, Contract

_SPEC = "map<string,array<struct<name:string,kind:string,nullable:boolean>>>"


def _strings(values: Iterable[str]) -> Column:
    values = list(values)
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _specs(contract: Contract) -> Column:
    """The whole contract as one constant map, so the plan does not grow with its columns."""
    spec = {
        m: [{"name": c.name, "kind": DTYPES.get(c.dtype, "string"), "nullable": c.nullable} for c in cols]
        for m, cols in contract.modules.items()
    }
    return F.from_json(F.lit(json.dumps(spec)), _SPEC)


# A filter on the error column would be pushed below the parsing and copy it several times over.
# Filters do not move below a stage with a partition id, so the last parsing stage carries one.
_PIN = "_pin"


def _pinned(cond: Column) -> Column:
    return F.when(F.col(_PIN) >= 0, cond)


def with_row_error(df: DataFrame, contract: Contract, module: str = "module", data: str = "data", out: str = "error") -> DataFrame:
    """Add the first broken rule of a JSON row as ``struct(message, details)``, NULL for valid rows.

    Order: malformed, unknown module, column order, extra, missing or NULL, type. The row is
    parsed once; numbers may come as text, as lenient as a cast, but text must be text.
    """
    rules = contract.rules
    df = df.withColumns({
        "_spec": F.try_element_at(_specs(contract), F.col(module)), "_keys": F.json_object_keys(data),
        "_vals": F.from_json(data, "map<string,variant>"),
    }).withColumn("_expected", F.transform("_spec", lambda c: c["name"]))

    def problem(c):
        v = F.try_element_at(F.col("_vals"), c["name"])
        absent = v.isNull() | F.is_variant_null(v)
        shown = F.schema_of_variant(v)
        numeric = shown.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | shown.startswith("DECIMAL")
        fits = (
            F.when((c["kind"] == "double") & numeric, True).when(c["kind"] == "double", v.try_cast("double").isNotNull()).when(c["kind"] == "bigint", v.try_cast("bigint").isNotNull())
            .when(c["kind"] == "boolean", v.try_cast("boolean").isNotNull()).when(c["kind"] == "timestamp", v.try_cast("timestamp").isNotNull())
            .otherwise(shown == "STRING")
        )
        lost = F.when(absent & ~c["nullable"], F.concat(c["name"], F.lit(": missing or null"))) if rules["reject_null_violations"] else None
        wrong = F.when(~absent & ~fits, F.concat(c["name"], F.lit(": not "), c["kind"])) if rules["enforce_dtypes"] else None
        return F.coalesce(*[x for x in (lost, wrong) if x is not None], F.lit(None).cast("string"))

    df = df.withColumns({
        "_extra": F.array_except("_keys", "_expected"), "_bad": F.array_compact(F.transform("_spec", problem)),
        _PIN: F.spark_partition_id(),
    })

    def err(message, details):
        return F.struct(F.lit(message).alias("message"), details.alias("details"))

    found = F.when(F.col("_keys").isNull(), err("Malformed row", F.col(data)))
    found = found.when(F.col("_spec").isNull(), err("Unknown module", F.col(module)))
    if rules["enforce_column_order"]:
        order = F.to_json(F.struct(F.col("_expected").alias("expected"), F.col("_keys").alias("actual")))
        found = found.when(F.col("_keys") != F.col("_expected"), err("Column order mismatch", order))
    if not rules["allow_extra_fields"]:
        found = found.when(F.size("_extra") > 0, err("Schema validation failed", F.to_json("_extra")))
    found = found.when(F.size("_bad") > 0, err("Schema validation failed", F.to_json("_bad")))
    return df.withColumn(out, _pinned(found)).drop("_spec", "_keys", "_vals", "_expected", "_extra", "_bad", _PIN)


def with_envelope_error(df: DataFrame, contract: Contract, raw: str, out: str = "problem") -> DataFrame:
    """Add what is wrong with the envelope itself: unreadable JSON, missing or empty metadata, extra keys."""
    df = df.withColumn("_m", F.get_json_object(raw, "$.metadata")).withColumns({
        "_meta": F.from_json("_m", "map<string,string>"), "_top": F.json_object_keys(raw), "_mk": F.json_object_keys("_m"),
    })
    lacking = F.filter(_strings(METADATA), lambda m: F.coalesce(F.length(F.try_element_at(F.col("_meta"), m)), F.lit(0)) == 0)
    df = df.withColumns({"_lacking": lacking, "_data": F.get_json_object(raw, "$.data"), _PIN: F.spark_partition_id()})
    extra = F.size(F.array_except("_mk", _strings((*METADATA, "ingest_ts")))) > 0
    top = F.size(F.array_except("_top", _strings(("metadata", "data")))) > 0
    unknown = ~F.try_element_at(F.col("_meta"), F.lit("module")).isin(*contract.modules)
    problem = (
        F.when(F.col("_top").isNull() | F.col("_meta").isNull() | F.col("_data").isNull(), "malformed envelope")
        .when(F.size("_lacking") > 0, F.concat(F.lit("metadata missing: "), F.array_join("_lacking", ",")))
        .when(extra | top, "unexpected envelope fields").when(unknown, "unknown module")
    )
    return df.withColumn(out, _pinned(problem)).drop("_m", "_meta", "_top", "_mk", "_lacking", "_data", _PIN)


def split_valid(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects) by the error column of a single pass."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def schema_profile(df: DataFrame) -> DataFrame:
    """Type, NULLs and a sample value per column, in one aggregate over the whole frame."""
    cols = df.columns
    picks = []
    for c in cols:
        picks += [
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            F.min(F.col(c).cast("string")).alias(f"{c}__example"),
        ]
    one = df.agg(F.count("*").alias("_rows"), *picks)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                (F.col(f"{c}__nulls") > 0).alias("has_null"), F.col(f"{c}__example").alias("example"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def header_mismatches(headers: DataFrame, reference: str, file: str = "vehicle") -> DataFrame:
    """``headers(vehicle, module, cols)`` that differ in names or order from the reference vehicle's."""
    ref = headers.filter(F.col(file) == reference).select("module", F.col("cols").alias("ref"))
    joined = headers.filter(F.col(file) != reference).join(F.broadcast(ref), "module")
    return joined.filter("cols <> ref").select(
        file, "module", F.array_except("ref", "cols").alias("missing"), F.array_except("cols", "ref").alias("extra"),
        (F.array_sort("cols") == F.array_sort("ref")).alias("order_only"),
    )


# Columns added by the pipeline itself (fixed values).
SYSTEM_COLUMNS = ("row_hash", "ingest_ts", "writer_ts", "source_id", "timestamp", "date")


def feature_compatibility(features: Column, columns: Column) -> dict[str, Column]:
    """Features without a table column (derived ``_mean``/``_std`` stripped) and columns no feature uses."""
    base = F.array_distinct(F.transform(features, lambda f: F.regexp_replace(f, "_(mean|std)$", "")))
    return {
        "missing": F.array_except(base, columns),
        "unused": F.array_except(F.array_except(columns, base), _strings(SYSTEM_COLUMNS)),
    }


def dtc_compatibility(catalog: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features absent per code, usable codes per module) for ``columns(module, column)``."""
    need = catalog.select("module", "dtc_code", F.explode("features").alias("column"))
    have = columns.select("module", "column").distinct()
    absent = need.join(have, ["module", "column"], "left_anti")
    per_code = absent.groupBy("module", "dtc_code").agg(F.sort_array(F.collect_list("column")).alias("absent"))
    total = catalog.groupBy("module").agg(F.count("*").alias("n_total"))
    bad = per_code.groupBy("module").agg(F.count("*").alias("n_bad"))
    summary = total.join(bad, "module", "left").select(
        "module", (F.col("n_total") - F.coalesce("n_bad", F.lit(0))).alias("n_ok"), "n_total"
    )
    return per_code, summary


def sensor_policy(expected: Column, present: Column, most: int = 3) -> tuple[Column, Column]:
    """(action, masked features): more than ``most`` missing sensors abort, fewer are masked."""
    missing = F.array_except(expected, present)
    action = F.when(F.size(missing) > most, "abort").when(F.size(missing) > 0, "mask").otherwise("ok")
    return action, missing


def valid_files(df: DataFrame, file: str, targets: list[str], ts: str = "ts", share: float = 0.1) -> DataFrame:
    """Files in which every target has at least ``share`` non-null values among rows with a time."""
    ok = F.lit(True)
    for t in targets:
        ok = ok & (F.avg(F.col(t).isNotNull().cast("double")) >= share)
    return df.filter(F.col(ts).isNotNull()).groupBy(file).agg(ok.alias("_ok")).filter("_ok").select(file)


def resolve_headers(columns: list[str], wanted: dict[str, str]) -> dict[str, str] | None:
    """canonical name -> first column that contains the wanted text, ignoring case; None if one is absent."""
    out = {}
    for canonical, part in wanted.items():
        hit = next((c for c in columns if part.lower() in c.lower()), None)
        if hit is None:
            return None
        out[canonical] = hit
    return out


def resolve_header_rows(cols: Column, wanted: dict[str, str]) -> Column:
    """Column form of `resolve_headers`: map of canonical name to column, NULL if one is absent."""
    def first_with(part):
        return F.get(F.filter(cols, lambda c: F.lower(c).contains(part.lower())), F.lit(0))

    hits = [first_with(part) for part in wanted.values()]
    found = F.map_from_arrays(_strings(wanted), F.array(*hits))
    complete = hits[0].isNotNull()
    for h in hits[1:]:
        complete = complete & h.isNotNull()
    return F.when(complete, found)


def first_occurrence(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Exact de-duplication that always keeps the same row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")

"""Telemetry contract: ordered, typed columns per module, and checks on it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract dtype -> Spark type (fixed values); anything else is text.
DTYPES = {
    "float64": "double", "float": "double", "int64": "bigint", "int": "bigint", "bool": "boolean",
    "boolean": "boolean", "datetime": "timestamp", "iso8601": "timestamp", "object": "string",
}
METADATA = ("row_hash", "vehicle_id", "module", "source_file")
RULES = ("strict_columns", "allow_extra_fields", "enforce_column_order", "enforce_dtypes", "reject_null_violations")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    nullable: bool = False


@dataclass(frozen=True)
class Contract:
    modules: dict[str, tuple[ColumnSpec, ...]]
    rules: dict[str, bool] = field(default_factory=lambda: {r: r != "allow_extra_fields" for r in RULES})
    patterns: dict[str, str] = field(default_factory=dict)
    raw: dict | None = None

    @classmethod
    def from_json(cls, text: str) -> Contract:
        doc = json.loads(text)
        modules, patterns = {}, {}
        for name, spec in doc["modules"].items():
            modules[name] = tuple(ColumnSpec(c, s["dtype"], s.get("nullable", False)) for c, s in spec["columns"].items())
            patterns[name] = spec.get("file_pattern", f"{name}*.csv")
        rules = doc.get("validation_rules") or {r: r != "allow_extra_fields" for r in RULES}
        return cls(modules, {r: bool(rules.get(r, False)) for r in RULES}, patterns, doc)

    @classmethod
    def load(cls, path: str) -> Contract:
        return cls.from_json(Path(path).read_text())

    def columns(self, module: str) -> list[str]:
        return [c.name for c in self.modules[module]]

    def data_schema(self, module: str) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.DataType.fromDDL(DTYPES.get(c.dtype, "string"))) for c in self.modules[module]])

    def envelope_schema(self, module: str) -> T.StructType:
        meta = T.StructType([T.StructField(m, T.StringType()) for m in (*METADATA, "ingest_ts")])
        return T.StructType([T.StructField("metadata", meta), T.StructField("data", self.data_schema(module))])

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(m, i, c.name, c.dtype, c.nullable) for m, cols in self.modules.items() for i, c in enumerate(cols)]
        return spark.createDataFrame(rows, "module string, ordinal int, column string, dtype string, nullable boolean")


def contract_violations(document: DataFrame, text: str = "value") -> DataFrame:
    """One row per broken requirement of a contract document (one JSON text per row)."""
    mod = "struct<column_count:bigint,columns:map<string,struct<dtype:string,nullable:boolean>>>"
    shape = f"struct<contract_version:string,modules:map<string,{mod}>,metadata:map<string,string>,validation_rules:map<string,boolean>>"
    d = document.select(text, F.from_json(text, shape).alias("d"))
    named = lambda ok, what: F.when(~F.coalesce(ok, F.lit(False)), F.array(F.lit(what))).otherwise(F.array().cast("array<string>"))
    per_module = F.flatten(
        F.transform(
            F.map_entries("d.modules"),
            lambda e: F.concat(
                F.when(e["value"]["columns"].isNull(), F.array(F.concat(e["key"], F.lit(": no columns")))).otherwise(F.array().cast("array<string>")),
                F.when(e["value"]["column_count"].isNull(), F.array(F.concat(e["key"], F.lit(": no column_count"))))
                .when(e["value"]["column_count"] != F.size(e["value"]["columns"]), F.array(F.concat(e["key"], F.lit(": column_count differs"))))
                .otherwise(F.array().cast("array<string>")),
            ),
        )
    )
    checks = [
        named(F.col("d.contract_version") == "v1", "version is not v1"),
        named(F.col("d.modules").isNotNull(), "modules missing"),
        named(F.col("d.validation_rules").isNotNull(), "validation_rules missing"),
        *[named(F.map_contains_key("d.metadata", F.lit(m)), f"metadata field {m} missing") for m in METADATA],
        *[named(F.map_contains_key("d.validation_rules", F.lit(r)), f"rule {r} missing") for r in RULES],
        F.coalesce(per_module, F.array().cast("array<string>")),
    ]
    return d.select(text, F.explode(F.concat(*checks)).alias("violation"))


def build_contract(columns: DataFrame, version: str = "v1") -> DataFrame:
    """One merged JSON document with its SHA-256 from ``(module, ordinal, column, dtype, nullable)`` rows."""
    col = F.struct("ordinal", "column", "dtype", "nullable")
    per_module = columns.groupBy("module").agg(F.sort_array(F.collect_list(col)).alias("columns"))
    doc = per_module.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("module", F.size("columns").alias("column_count"), "columns"))).alias("modules")
    )
    body = doc.select(F.to_json(F.struct(F.lit(version).alias("contract_version"), "modules")).alias("document"))
    return body.withColumn("checksum", F.sha2("document", 256))

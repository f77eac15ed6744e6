"""Raw envelopes to bronze rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from motorpool.contract import Contract
from motorpool.functions.timefmt import parse_iso


def row_hash(features: list[str], module: Column, vehicle: Column, timestamp: Column) -> Column:
    """SHA-256 of the canonical JSON of the raw text values, keys sorted on both levels, NULLs kept."""
    body = F.struct(
        F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(features)]).alias("features"),
        module.alias("module"), timestamp.cast("string").alias("timestamp"), vehicle.alias("vehicle_id"),
    )
    return F.sha2(F.to_json(body, {"ignoreNullFields": "false"}), 256)


def envelope(data: Column, hash_: Column, vehicle: Column, module: Column, source_file: Column) -> Column:
    meta = F.struct(hash_.alias("row_hash"), vehicle.alias("vehicle_id"), module.alias("module"), source_file.alias("source_file"))
    return F.to_json(F.struct(meta.alias("metadata"), data.alias("data")))


def stamp(df: DataFrame, column: str, now: Column | None = None) -> DataFrame:
    return df.withColumn(column, now if now is not None else F.current_timestamp())


def flatten(raw: DataFrame, contract: Contract, module: str, value: str = "value", writer_ts: Column | None = None) -> DataFrame:
    """Bronze layout of one module's envelopes; unreadable ones keep a NULL ``row_hash``."""
    # Cut-off JSON would still parse in part; a wrong field in good JSON is only a NULL field.
    whole = F.try_parse_json(value).isNotNull()
    parsed = raw.withColumn("_p", F.when(whole, F.from_json(value, contract.envelope_schema(module))))
    cols = [c for c in contract.columns(module) if c != "source_id"]
    return parsed.select(
        F.col("_p.metadata.row_hash").alias("row_hash"), parse_iso(F.col("_p.metadata.ingest_ts")).alias("ingest_ts"),
        (writer_ts if writer_ts is not None else F.current_timestamp()).alias("writer_ts"),
        F.col("_p.metadata.vehicle_id").alias("source_id"), *[F.col(f"_p.data.{c}").alias(c) for c in cols],
    )


def _widened(has: list[str], columns: dict[str, DataType]) -> Callable[[Column], Column]:
    """An envelope whose data has all ``columns``, NULL but for those in ``has``."""

    def widen(p: Column) -> Column:
        data = F.struct(*[(p["data"][c] if c in has else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])
        return F.struct(p["metadata"].alias("metadata"), data.alias("data"))

    return widen


def by_module(raw: DataFrame, contract: Contract, keep: list[str], value: str = "value", module: str = "module") -> DataFrame:
    """``keep`` and ``_p``, the envelope parsed under the schema of its row's module, for all modules in one pass.

    ``_p.data`` has the columns of all modules, NULL where a row's module has none; columns of one name must have one
    type. Rows of unknown modules and unreadable ones have no ``_p``. Each text is parsed once, whatever is filtered.
    """
    alike: dict[str, list[str]] = {}  # modules of equal columns share one parse
    for name in contract.modules:
        alike.setdefault(contract.data_schema(name).json(), []).append(name)
    columns = {f.name: f.dataType for names in alike.values() for f in contract.data_schema(names[0])}
    parsed = None
    for names in alike.values():
        case = F.from_json(value, contract.envelope_schema(names[0]))
        if len(alike) > 1:
            case = F.transform(F.array(case), _widened(contract.columns(names[0]), columns))[0]
        parsed = F.when(F.col(module).isin(names), case) if parsed is None else parsed.when(F.col(module).isin(names), case)
    # Cut-off JSON would still parse in part. A generator keeps filters on its result from repeating the parse.
    whole = F.when(F.try_parse_json(value).isNotNull(), parsed)
    return raw.select(*keep, F.explode(F.array(whole)).alias("_p"))


def flatten_all(raw: DataFrame, contract: Contract, value: str = "value", module: str = "module", writer_ts: Column | None = None) -> DataFrame:
    """:func:`flatten` for the envelopes of all modules at once, with ``module`` and the columns of all of them."""
    cols = dict.fromkeys(c for name in contract.modules for c in contract.columns(name) if c not in ("source_id", module))
    return by_module(raw, contract, [module], value, module).select(
        module, F.col("_p.metadata.row_hash").alias("row_hash"), parse_iso(F.col("_p.metadata.ingest_ts")).alias("ingest_ts"),
        (writer_ts if writer_ts is not None else F.current_timestamp()).alias("writer_ts"),
        F.col("_p.metadata.vehicle_id").alias("source_id"), *[F.col(f"_p.data.{c}").alias(c) for c in cols],
    )


def split_unreadable(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return bronze.filter("row_hash IS NOT NULL"), bronze.filter("row_hash IS NULL")

"""Joins on keys in which NULL equals NULL, as it does in grouping and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", small: bool = False) -> DataFrame:
    """``left.join(right, keys, how)`` where a NULL key finds a NULL key; ``small`` broadcasts the right side."""
    side = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    out = left.join(F.broadcast(side) if small else side, same, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*[f"_right_{k}" for k in keys])

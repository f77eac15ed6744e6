"""Rounding, coercion and clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two halves


def round_py(x: Column, places: int) -> Column:
    """Correctly rounded to ``places`` decimals, exact ties to even, as Python's ``round``.

    ``F.round`` rounds the shortest decimal text instead, which differs for values such
    as 2.675. The product error is recovered exactly, so the comparison with one half is too.
    """
    scale = float(10**places)
    c, d = _SPLIT * x, _SPLIT * scale
    s_hi = d - (d - scale)
    s_lo = scale - s_hi
    x_hi = c - (c - x)
    x_lo = x - x_hi
    p = x * scale
    err = ((x_hi * s_hi - p) + x_hi * s_lo + x_lo * s_hi) + x_lo * s_lo
    base = F.floor(p).cast("double")
    side = (p - base - 0.5) + err
    up = F.when(side > 0, 1.0).when(side < 0, 0.0).otherwise(F.pmod(base, F.lit(2.0)))
    return F.when(F.abs(p) < 4.5e15, (base + up) / scale).otherwise(x)


def to_double(c: Column) -> Column:
    """Numbers from text; anything else becomes NULL."""
    return c.try_cast("double")


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def sanitise(df: DataFrame, zero_fill: bool = True) -> DataFrame:
    """JSON-safe frame: finite numbers, timestamps as text, missing numbers as 0."""
    out = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.coalesce(finite(c), F.lit(0.0)) if zero_fill else finite(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.NumericType) and zero_fill:
            out[f.name] = F.coalesce(c, F.lit(0).cast(f.dataType))
    return df.withColumns(out)


def standard_scale(x: Column, mean: Column, std: Column) -> Column:
    """Population scaling; a constant feature is only centred."""
    return (x - mean) / F.when(std == 0, 1.0).otherwise(std)


def minmax_scale(x: Column, lo: Column, hi: Column) -> Column:
    return (x - lo) / F.when(hi == lo, 1.0).otherwise(hi - lo)

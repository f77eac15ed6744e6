"""Deterministic pseudo-random columns from row keys: the same on every run and retry."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = float(16**12)


def hash_number(salt: str, *keys: Column | str) -> Column:
    """0 .. 16**12 - 1 from the MD5 of the keys' text."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def uniform(salt: str, *keys) -> Column:
    """In (0, 1)."""
    return (hash_number(salt, *keys) + 0.5) / _SPACE


def normal(salt: str, *keys) -> Column:
    """Standard normal by the Box-Muller transform of two hashes."""
    return F.sqrt(-2.0 * F.ln(uniform(salt + "a", *keys))) * F.cos(2.0 * pi * uniform(salt + "b", *keys))

"""Ordered folds over composable steps.

A step is a map ``state -> state`` taken from a family that is closed under
composition. A chunk then reduces to one summary; the start state of each chunk
follows from the summaries before it, and all chunks replay independently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorpool.functions.keys import null_safe_join

_BLOCK = 64


@dataclass(frozen=True)
class Clamp:
    """``x -> min(hi, max(lo, x + d))``; input fields ``d``, ``lo``, ``hi``."""

    fields = ("d", "lo", "hi")

    @staticmethod
    def identity() -> Column:
        inf = F.lit(float("inf"))
        return F.struct(F.lit(0.0).alias("d"), (-inf).alias("lo"), inf.alias("hi"))

    @staticmethod
    def compose(a: Column, b: Column) -> Column:
        clip = lambda v: F.least(b["hi"], F.greatest(b["lo"], v))
        return F.struct(
            (a["d"] + b["d"]).alias("d"), clip(a["lo"] + b["d"]).alias("lo"), clip(a["hi"] + b["d"]).alias("hi")
        )

    @staticmethod
    def act(state: Column, m: Column) -> Column:
        return F.least(m["hi"], F.greatest(m["lo"], state + m["d"]))


@dataclass(frozen=True)
class Affine:
    """``x -> a * x + b``; input fields ``a``, ``b``. Exponential smoothing is one of these."""

    fields = ("a", "b")

    @staticmethod
    def identity() -> Column:
        return F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))

    @staticmethod
    def compose(p: Column, q: Column) -> Column:
        return F.struct((p["a"] * q["a"]).alias("a"), (q["a"] * p["b"] + q["b"]).alias("b"))

    @staticmethod
    def act(state: Column, m: Column) -> Column:
        return m["a"] * state + m["b"]


def chained_states(rows: Column, monoid, start: Column) -> Column:
    """States after each element of ``rows``, as blocks whose first element repeats the state before.

    Appending to one long array would copy it for every row; blocks keep the appends short.
    Use `unrolled` on a column that holds the result, so that the fold is evaluated once.
    """

    def block_states(seed, block):
        grow = lambda acc, r: F.concat(acc, F.array(monoid.act(F.element_at(acc, -1), r["_m"])))
        return F.aggregate(block, F.array(seed), grow)

    starts = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(starts, lambda i: F.slice(rows, i * _BLOCK + 1, F.lit(_BLOCK)))
    return F.aggregate(
        blocks,
        F.array(F.array(start)),
        lambda acc, b: F.concat(acc, F.array(block_states(F.element_at(F.element_at(acc, -1), -1), b))),
    )


def unrolled(chained: Column) -> Column:
    tail = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    return F.flatten(F.transform(tail(chained), tail))


def summarise(rows: Column, monoid) -> Column:
    return F.aggregate(rows, monoid.identity(), lambda acc, r: monoid.compose(acc, r["_m"]))


def apply_fold(series, out: str, monoid, start: Column, inputs: dict[str, Column]):
    """One shuffle on (key, chunk); the summary branch reuses it."""
    step = F.struct(*[inputs[f].cast("double").alias(f) for f in monoid.fields])
    rest = [c for c in series.df.columns if c not in series.parts and c not in series.order]
    row = F.struct(*[F.col(c) for c in series.order], step.alias("_m"), *[F.col(c) for c in rest])
    # Rows are shuffled as they are: a partial collect_list would only build lists twice.
    spread = series.df.repartition(*series.parts)
    parts = spread.groupBy(*series.parts).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    if series.hot:
        from motorpool.operators.series import CHUNK

        sums = parts.select(*series.parts, summarise(F.col("_rows"), monoid).alias("_m"))
        # One row per chunk; the chunks of a key are few, so their fold stays small.
        per_key = sums.groupBy(*series.keys).agg(
            F.sort_array(F.collect_list(F.struct(CHUNK, "_m"))).alias("_chunks")
        )
        per_key = per_key.withColumn("_s", chained_states(F.col("_chunks"), monoid, start))
        begin = F.slice(F.concat(F.array(start), unrolled(F.col("_s"))), 1, F.size("_chunks"))
        carried = per_key.select(
            *series.keys, F.explode(F.arrays_zip(F.col("_chunks")[CHUNK].alias("c"), begin.alias("s"))).alias("z")
        ).select(*series.keys, F.col("z.c").alias(CHUNK), F.col("z.s").alias("_start"))
        parts = null_safe_join(parts, carried, series.parts)
        start = F.col("_start")
    parts = parts.withColumn("_s", chained_states(F.col("_rows"), monoid, start))
    zipped = F.arrays_zip(F.col("_rows").alias("r"), unrolled(F.col("_s")).alias("s"))
    flat = parts.select(*series.parts, F.explode(zipped).alias("z"))
    return flat.select(
        *series.parts, *[F.col(f"z.r.{c}").alias(c) for c in (*series.order, *rest)], F.col("z.s").alias(out)
    )


def clamp_inputs(delta: Column, lo, hi) -> dict[str, Column]:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return {"d": delta, "lo": as_col(lo), "hi": as_col(hi)}

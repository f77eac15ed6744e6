"""Ordered, keyed operators that survive hot keys.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task. `Series`
measures the keys once with a map-side aggregate. While every key stays below
``target_rows`` the operators are ordinary windows. Keys above it are cut into
ordered chunks, windows run per (key, chunk), and what a chunk needs from its
neighbours (running sums, last values, fold states) is carried over from a table
with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.functions.keys import null_safe_join
from motorpool.session import cut

CHUNK = "_chunk"
TARGET_ROWS = 500_000
# Tables of measured size up to this many rows are broadcast, larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
# Sampled rows per chunk that the cut points are taken from.
_PER_CHUNK = 64
_BEFORE = (Window.unboundedPreceding, -1)
_AFTER = (1, Window.unboundedFollowing)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
_FROM = (Window.currentRow, Window.unboundedFollowing)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only when the measured row count allows it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class Run:
    """One running computation: kind and input expression."""

    kind: str
    expr: Column


def run_sum(expr: Column) -> Run:
    return Run("sum", expr)


def run_count() -> Run:
    return Run("sum", F.lit(1).cast("long"))


def run_sum_back(expr: Column) -> Run:
    """Sum from the current row to the end of the key."""
    return Run("sum_back", expr)


def run_min(expr: Column) -> Run:
    return Run("min", expr)


def run_max(expr: Column) -> Run:
    return Run("max", expr)


def previous(expr: Column) -> Run:
    return Run("lag", expr)


def following(expr: Column) -> Run:
    return Run("lead", expr)


def last_valid(expr: Column) -> Run:
    """Last non-null value up to and including the current row."""
    return Run("ffill", expr)


def next_valid(expr: Column) -> Run:
    """First non-null value from the current row on."""
    return Run("bfill", expr)


class Series:
    """A DataFrame with keys and a unique order inside each key.

    A NULL key is a key like any other; order columns must not be NULL. Keys above ``target_rows`` are cut into chunks
    along the full order.
    """

    def __init__(self, df, keys, order, target_rows: int = TARGET_ROWS, _state=None):
        if not keys:
            raise ValueError("a series needs a key; use a constant column for one global series")
        self.keys, self.order, self.target_rows = list(keys), list(order), target_rows
        if _state is not None:
            self.df, self.hot, self.n_chunks, self.cold = df, *_state
            self.derived = True
        else:
            self.df, self.hot, self.n_chunks = self._split(df)
            # Key sets known to have no heavy group; finer keys then have none either.
            self.cold = frozenset() if self.hot else frozenset([frozenset(self.keys)])
            self.derived = False
        self.parts = [*self.keys, CHUNK] if self.hot else self.keys

    def _split(self, df: DataFrame):
        stats = df.groupBy(*self.keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > self.target_rows)
        # At most (all rows / target_rows) keys can be this large, so the list is short.
        heavy = stats.collect()
        if not heavy:
            return df, False, 0
        chunks = [-(-r["_n"] // self.target_rows) for r in heavy]
        # Points are looked through in two steps: the first of each group, then a group of about the root of their number.
        n, step = sum(chunks), isqrt(max(chunks)) + 1
        heavy_df = df.sparkSession.createDataFrame(heavy, stats.schema)
        # Cut points at measured quantiles of the full order: a clock that jumps, or many rows at one
        # instant, do not matter. They come from a hash sample of some dozens of rows per chunk.
        m = F.ceil(F.col("_n") / self.target_rows)
        some = self._attach(df.select(*self.keys, *self.order), heavy_df, self.keys, len(heavy), "inner").filter(
            F.pmod(F.xxhash64(*self.order), F.greatest(F.floor(F.col("_n") / (m * _PER_CHUNK)), F.lit(1))) == 0
        ).select(*self.keys, m.alias("_m"), F.struct(*self.order).alias("_o"))
        w = Window.partitionBy(*self.keys)
        # Columns of its own, so that no key of the caller's is replaced by one of them.
        share = lambda r: F.floor(r * F.col("_m") / F.col("_in_sample"))
        placed = some.withColumns({"_in_sample": F.count("*").over(w), "_sample_row": F.row_number().over(w.orderBy("_o"))})
        points = placed.filter((share(F.col("_sample_row") - 1) != share(F.col("_sample_row"))) & (F.col("_sample_row") < F.col("_in_sample")))
        cuts = cut(
            points.groupBy(*self.keys).agg(F.sort_array(F.collect_set("_o")).alias("_cuts"))
            .withColumn("_coarse", F.filter("_cuts", lambda _, i: i % step == 0))
        )
        out = self._attach(df.withColumn("_o", F.struct(*self.order)), cuts, self.keys, n)
        below = lambda points: F.size(F.filter(points, lambda c: c < F.col("_o")))
        group = F.greatest(below(F.col("_coarse")) - 1, F.lit(0))
        out = out.withColumn("_g", group).withColumn(
            CHUNK, F.coalesce(F.col("_g") * step + below(F.slice("_cuts", F.col("_g") * step + 1, F.lit(step))), F.lit(0)).cast("long")
        )
        return out.drop("_o", "_g", "_cuts", "_coarse"), True, n

    @staticmethod
    def _attach(df, side, on, rows, how="left"):
        return null_safe_join(df, side, on, how, small=rows <= BROADCAST_ROWS)

    @classmethod
    def bounded(cls, df, keys, order, max_rows: int, target_rows: int = TARGET_ROWS) -> Series:
        """Series whose keys hold ``max_rows`` rows at most by construction; measured only if that is too many."""
        if max_rows > target_rows:
            return cls(df, keys, order, target_rows)
        return cls(df, keys, order, target_rows, _state=(False, 0, frozenset([frozenset(keys)])))

    def with_df(self, df: DataFrame) -> Series:
        """Same keys and chunks over a derived frame that kept all rows' key, order and chunk."""
        return Series(df, self.keys, self.order, self.target_rows, _state=(self.hot, self.n_chunks, self.cold))

    def is_cold(self, keys) -> bool:
        return any(known <= set(keys) for known in self.cold)

    def rekey(self, keys, order=None) -> Series:
        """The same rows under other keys; measured again only if those could be heavy."""
        order = order or self.order
        if self.is_cold(keys):
            return Series(self.result(), keys, order, self.target_rows, _state=(False, 0, self.cold))
        fresh = Series(cut(self.result()), keys, order, self.target_rows)
        fresh.cold = fresh.cold | self.cold
        return fresh

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def window(self):
        return Window.partitionBy(*self.parts).orderBy(*self.order)

    # -- running computations -------------------------------------------------

    def running(self, **runs: Run) -> Series:
        """Add one column per `Run`, exact across chunks."""
        w = self.window()
        local = {name: self._local(run, w) for name, run in runs.items()}
        if not self.hot:
            return self.with_df(self.df.withColumns(local))
        # The frame is read twice; a derived one is written out first so that long
        # chains of operators do not recompute each other.
        base = cut(self.df) if self.derived else self.df
        rank = F.struct(*self.order)
        parts = base.groupBy(*self.parts).agg(*[self._part(r, rank).alias(f"_p_{n}") for n, r in runs.items()])
        cw = Window.partitionBy(*self.keys).orderBy(CHUNK)
        carried = parts.select(*self.parts, *[self._carry(r, f"_p_{n}", cw).alias(f"_c_{n}") for n, r in runs.items()])
        # One row per (key, chunk): its size is the number of chunks plus the cold keys,
        # so only the rows that carry something are kept.
        some = [F.col(f"_c_{n}").isNotNull() for n in runs]
        keep = some[0]
        for cond in some[1:]:
            keep = keep | cond
        out = self._attach(base, carried.filter(keep), self.parts, self.n_chunks).withColumns(local)
        out = out.withColumns({n: self._combine(r, F.col(n), F.col(f"_c_{n}")) for n, r in runs.items()})
        return self.with_df(out.drop(*[f"_c_{n}" for n in runs]))

    def _local(self, run: Run, w):
        e = run.expr
        if run.kind in ("lag", "lead"):
            fn = F.lag if run.kind == "lag" else F.lead
            return fn(F.struct(e.alias("v"))).over(w) if self.hot else fn(e).over(w)
        frame = w.rowsBetween(*(_FROM if run.kind in ("bfill", "sum_back") else _UP_TO))
        fn = {
            "sum": F.sum, "sum_back": F.sum, "min": F.min, "max": F.max,
            "ffill": lambda c: F.last(c, ignorenulls=True), "bfill": lambda c: F.first(c, ignorenulls=True),
        }[run.kind]
        return fn(e).over(frame)

    @staticmethod
    def _part(run: Run, rank: Column) -> Column:
        e = run.expr
        valid = F.when(e.isNotNull(), rank)
        return {
            "sum": lambda: F.sum(e), "sum_back": lambda: F.sum(e), "min": lambda: F.min(e), "max": lambda: F.max(e),
            "ffill": lambda: F.max_by(e, valid), "bfill": lambda: F.min_by(e, valid),
            "lag": lambda: F.max_by(F.struct(e.alias("v")), rank), "lead": lambda: F.min_by(F.struct(e.alias("v")), rank),
        }[run.kind]()

    @staticmethod
    def _carry(run: Run, name: str, w) -> Column:
        return {
            "sum": lambda: F.sum(name).over(w.rowsBetween(*_BEFORE)),
            "sum_back": lambda: F.sum(name).over(w.rowsBetween(*_AFTER)),
            "min": lambda: F.min(name).over(w.rowsBetween(*_BEFORE)),
            "max": lambda: F.max(name).over(w.rowsBetween(*_BEFORE)),
            "ffill": lambda: F.last(name, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
            "bfill": lambda: F.first(name, ignorenulls=True).over(w.rowsBetween(*_AFTER)),
            "lag": lambda: F.lag(name).over(w),
            "lead": lambda: F.lead(name).over(w),
        }[run.kind]()

    @staticmethod
    def _combine(run: Run, local: Column, carried: Column) -> Column:
        if run.kind in ("lag", "lead"):
            return F.coalesce(local, carried).getField("v")
        if run.kind in ("sum", "sum_back"):
            return F.coalesce(carried + local, local, carried)
        if run.kind == "min":
            return F.least(local, carried)
        if run.kind == "max":
            return F.greatest(local, carried)
        return F.coalesce(local, carried)

    def indexed(self, name: str = "idx") -> Series:
        """Dense 0-based position of each row inside its key."""
        if not self.hot:
            return self.with_df(self.df.withColumn(name, F.row_number().over(self.window()).cast("long") - 1))
        s = self.running(**{name: run_count()})
        return s.with_df(s.df.withColumn(name, F.col(name) - 1))

    # -- bounded frames -------------------------------------------------------

    def rolling(self, before: int, after: int, **outs: Callable) -> Series:
        """Frames of ``before`` rows back to ``after`` rows ahead; each value maps a window to a column.

        Heavy keys are cut into blocks of consecutive positions; the few rows a
        neighbouring block needs are duplicated into it and dropped afterwards.
        """
        if not self.hot:
            w = self.window().rowsBetween(-before, after)
            return self.with_df(self.df.withColumns({n: fn(w) for n, fn in outs.items()}))
        size = max(self.target_rows, before + after + 1)
        s = self.indexed("_pos")
        home = F.floor(F.col("_pos") / size)
        first, last = F.floor((F.col("_pos") - after) / size), F.floor((F.col("_pos") + before) / size)
        spread = s.df.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(first, last)))
        w = Window.partitionBy(*self.keys, "_block").orderBy(*self.order).rowsBetween(-before, after)
        out = spread.withColumns({n: fn(w) for n, fn in outs.items()}).filter("_home = _block")
        return self.with_df(out.drop("_home", "_block", "_pos"))

    # -- ordered folds --------------------------------------------------------

    def fold(self, out: str, monoid, start: Column, **inputs: Column) -> Series:
        """State after each row of a recurrence whose steps compose (see `operators.fold`)."""
        from motorpool.operators.fold import apply_fold

        return self.with_df(apply_fold(self, out, monoid, start, inputs))

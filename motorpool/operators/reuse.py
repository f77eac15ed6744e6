"""Reuse distances: what a least-recently-used store of fixed size would still know, without keeping the store.

A store of C entries still holds a key exactly if fewer than C other keys were used since the key's last use. That
number is a count of points: with rows numbered by time and ``prev`` the row's last use of its key, it is the number of
earlier rows j with prev(j) < prev(i), less the prev(i) + 1 rows up to the last use, all of which have a smaller prev.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorpool.operators.series import TARGET_ROWS, Series, previous
from motorpool.session import cut

_LEAF = 64


def earlier_smaller(values: np.ndarray) -> np.ndarray:
    """For each element the number of elements before it that are strictly smaller, by merging sorted runs."""
    n = len(values)
    ranks = np.unique(values, return_inverse=True)[1].astype(np.int64)
    size = -(-n // _LEAF) * _LEAF
    padded = np.concatenate([ranks, np.full(size - n, n + 1)]).reshape(-1, _LEAF)
    before = np.tri(_LEAF, _LEAF, -1, bool)
    out = np.empty(size, np.int64).reshape(-1, _LEAF)
    for k in range(0, len(padded), 1024):
        rows = padded[k : k + 1024]
        out[k : k + 1024] = ((rows[:, None, :] < rows[:, :, None]) & before).sum(axis=2)
    out, flat, places = out.ravel()[:n], padded.ravel()[:n], np.arange(n)
    run, stride = _LEAF, n + 2
    while run < n:
        pair, right = places // (2 * run), places // run % 2 == 1
        left = np.sort(pair[~right] * stride + flat[~right])
        keys = pair[right] * stride
        out[right] += np.searchsorted(left, keys + flat[right]) - np.searchsorted(left, keys)
        run *= 2
    return out


def _counted(order: str, value: str, out: str):
    def count(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        return pd.DataFrame({"_pos": rows["_pos"].to_numpy(), out: earlier_smaller(rows[value].to_numpy())})

    return count


def reuse_distances(df: DataFrame, key: str, order: list[str], rows_a_block: int = TARGET_ROWS, out: str = "distance") -> DataFrame:
    """``df`` with ``out``: how many other keys were used between a row and the last use of its key, NULL at first use.

    Rows are ordered by ``order``, which must be unique. The count splits by blocks of ``rows_a_block`` rows in time and
    in last-use time: whole blocks on both axes are added up from a table of block sizes; what shares a block on one
    axis is counted inside that block. A block holds ``rows_a_block`` rows at most, because no two rows share a last
    use, so neither a hot key nor a long history is ever in one task. A NULL key is a key like any other.
    """
    columns = df.columns
    timed = Series(df.withColumn("_all", F.lit(0)), ["_all"], order, rows_a_block).indexed("_pos")
    base = cut(timed.result().drop("_all").withColumn("_key", F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))))
    uses = Series(base.select("_key", "_pos"), ["_key"], ["_pos"], rows_a_block).running(_prev=previous(F.col("_pos")))
    block = lambda c: F.floor(F.col(c) / F.lit(rows_a_block)).cast("int")
    points = cut(uses.result().select("_pos", F.coalesce("_prev", F.lit(-1)).cast("long").alias("_prev")).withColumns({"_b": block("_pos")}).withColumn("_v", block("_prev")))

    own = points.groupBy("_b").applyInPandas(_counted("_pos", "_prev", "_own"), "_pos long, _own long")
    side = points.filter("_v >= 0").groupBy("_v").applyInPandas(_counted("_prev", "_b", "_side"), "_pos long, _side long")

    # whole blocks: for every (time block, last-use block) the rows in earlier time blocks with an earlier last-use block
    cells = points.groupBy("_b", "_v").agg(F.count("*").alias("_n"))
    blocks = points.agg(F.max("_b").alias("_last"))
    grid = blocks.select(F.explode(F.sequence(F.lit(-1), F.col("_last"))).alias("_v"), "_last")
    grid = grid.select("_v", F.explode(F.sequence(F.greatest("_v", F.lit(0)), F.col("_last"))).alias("_b"))
    down = Window.partitionBy("_v").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    whole = grid.join(cells, ["_b", "_v"], "left").withColumn("_down", F.coalesce(F.sum("_n").over(down), F.lit(0)))
    whole = whole.select("_b", "_v", F.coalesce(F.sum("_down").over(along), F.lit(0)).alias("_whole"))

    again = points.filter("_prev >= 0").join(whole, ["_b", "_v"]).join(own, "_pos").join(side, "_pos")
    distance = F.col("_whole") + F.col("_own") + F.col("_side") - F.col("_prev") - 1
    found = again.select("_pos", distance.alias("_d"))
    return base.join(found, "_pos", "left").select(*columns, F.col("_d").alias(out))


def capacity_outcomes(df: DataFrame, key: str, order: list[str], capacity: int = 500_000, rows_a_block: int = TARGET_ROWS) -> DataFrame:
    """``df`` with ``accepted``: false where a store of the ``capacity`` last used keys still knows the row's key."""
    rows = reuse_distances(df, key, order, rows_a_block, "_distance")
    return rows.withColumn("accepted", F.coalesce(F.col("_distance") >= capacity, F.lit(True))).drop("_distance")

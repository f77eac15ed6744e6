"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some tokens of a window and skip the others, so a replaced token at a skipped place leaves the hash
as it is. Equal hashes of test items and documents name a diagonal; along it the tokens are compared, and a leak is a
window in which nearly all tokens agree. Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import written

#: Fixed masks (1 is hashed, 0 skipped), and the least and greatest number of tokens of the items they are for. Whatever
#: tokens the rule below lets differ, one of an item's masks fits between them at some place; the tests enumerate this.
MASKS = (
    ("11111", 9, 1 << 30), ("110111", 9, 1 << 30), ("11010011", 9, 1 << 30),
    ("1111", 5, 8), ("11011", 5, 8), ("10111", 5, 8), ("11101", 5, 8),
    ("1111", 4, 4), ("111", 3, 3), ("11", 2, 2), ("1", 1, 1),
)
#: A leak is a window of so many tokens (the whole item, if shorter) of which so many percent agree in place.
WINDOW, AGREE = 16, 80
#: Test hashes up to this number are broadcast (24 bytes each); above it both sides are shuffled by hash.
BROADCAST_SEEDS = 500_000


def tokens(text: str) -> F.Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", -1), "")


def seeds(df: DataFrame, masks: tuple[tuple[str, int, int], ...] = MASKS) -> DataFrame:
    """``df`` with ``_words`` becomes a row per window and mask: ``_seed``, the window's place ``_at``, the mask's number
    ``_mask`` and the number of tokens ``_n``."""
    made = df.withColumn("_h", F.expr("transform(_words, w -> xxhash64(w))")).drop("_words")
    lists = []
    for n, (mask, _, _) in enumerate(masks):
        picked = ", ".join(f"get(_h, i + {k})" for k, bit in enumerate(mask) if bit == "1")
        lists.append(f"case when size(_h) > 0 then transform(sequence(0, size(_h) - 1), i -> if(i + {len(mask)} <= size(_h), xxhash64({n}, {picked}), null)) else array() end")
    rest = [c for c in df.columns if c != "_words"]
    spread = made.select(*rest, F.size("_h").alias("_n"), F.expr(f"concat({', '.join(lists)})").alias("_seeds"))
    # the outer form: the inner one would infer a filter on the size and compute the lists within it again
    rows = spread.select(*rest, "_n", F.posexplode_outer("_seeds").alias("_p", "_seed")).where("_seed is not null")
    return rows.select(*rest, "_seed", F.expr("_p % _n").alias("_at"), F.expr("_p div _n").alias("_mask"), "_n")


def leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    masks: tuple[tuple[str, int, int], ...] = MASKS, window: int = WINDOW, agree: int = AGREE,
) -> DataFrame:
    """Documents that hold a passage of a test item: (id, item id, ``start`` word of the passage, ``matched`` words).

    ``matched`` is the greatest number of agreeing tokens in one window, ``start`` the first place of such a window.
    One row per document and item. Items of fewer than five tokens must agree in all of them; those without any match
    nothing. Null texts and ids match nothing, repeated rows change nothing, empty tables give no rows. ``masks`` are
    complete for the ``window`` and ``agree`` set here; other values need masks of their own.
    """
    have = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull())
    test = written(have.select(F.col(item_id).alias("_item"), tokens(item_text).alias("_words")), "items")
    # documents are hashed under the masks of those lengths only that items have
    lengths = [r[0] for r in test.select(F.least(F.size("_words"), F.lit(9))).distinct().collect()]
    masks = tuple(m for m in masks if any(m[1] <= n <= m[2] for n in lengths)) or masks[:1]
    meant = " or ".join(f"_mask = {k} and _n between {least} and {most}" for k, (_, least, most) in enumerate(masks))
    probe = written(seeds(test, masks).where(meant).select("_seed", "_item", F.col("_at").alias("_of")).distinct(), "seeds")
    if probe.count() <= BROADCAST_SEEDS:
        probe = F.broadcast(probe)
    known = docs.where(F.col(id_col).isNotNull() & F.col(text).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    found = seeds(known.select("_id", tokens("_text").alias("_words")), masks).join(probe, "_seed")
    hits = written(found.select("_id", "_item", (F.col("_at") - F.col("_of")).alias("_shift")).distinct(), "hits")
    pairs = hits.join(known, "_id").select("_id", "_item", "_shift", tokens("_text").alias("_words"))
    pairs = pairs.join(test.withColumnRenamed("_words", "_wanted"), "_item")
    # the two stretches of tokens side by side; outside of the document nothing agrees
    skip, from_ = "greatest(-_shift, 0)", "greatest(_shift, 0)"
    side = f"zip_with(slice(_words, {from_} + 1, size(_wanted) - {skip}), slice(_wanted, {skip} + 1, size(_wanted)), (x, y) -> if(x = y, 1, 0))"
    same = pairs.withColumn("_same", F.expr(f"concat(array_repeat(0, {skip}), {side})"))
    w = f"least({window}, size(_same))"
    counts = f"transform(sequence(0, size(_same) - {w}), j -> struct(aggregate(slice(_same, j + 1, {w}), 0, (a, x) -> a + x) as matched, -(_shift + j) as place))"
    best = same.select("_id", "_item", F.expr(w).alias("_w"), F.expr(f"array_max({counts})").alias("_best"))
    leak = best.where(f"100 * _best.matched >= {agree} * _w").groupBy("_id", "_item").agg(F.max("_best").alias("_best"))
    return leak.select(
        F.col("_id").alias(id_col), F.col("_item").alias(item_id),
        F.greatest(-F.col("_best.place"), F.lit(0)).cast("long").alias("start"), F.col("_best.matched").cast("long").alias("matched"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", **kw) -> DataFrame:
    """``docs`` without the documents that hold a passage of a test item. Rows without an id stay."""
    found = leaks(docs, items, text, id_col, **kw).select(F.col(id_col).alias("_leaked")).distinct()
    return docs.join(found, docs[id_col] == F.col("_leaked"), "left_anti")

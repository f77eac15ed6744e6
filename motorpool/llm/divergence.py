"""How far the sources of a language are from each other in their words: pointer sort, counts, exact smoothed shares.

Tasks point at the word starts of their texts in Arrow buffers and sort the pointers, not the words. Equal runs of a
slice give each term's occurrences and documents per source; Spark adds the slices up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches, slices, utf8, written

SLICE = 4 << 20
TILE = 128
TERMS_PER_SALT = 16_384
LEAST_SALTS = 8
BLOCK_CELLS = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Which of the eight bytes at a pointer belong to a term with so many bytes left.
_KEEP = np.array([0] + [(0xFFFFFFFFFFFFFFFF << (8 * (8 - k))) & 0xFFFFFFFFFFFFFFFF for k in range(1, 9)], np.uint64)


def _keys(text8: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each term as one number that sorts as the bytes do; past the end of a term come zeros."""
    return text8[np.minimum(at, len(text8) - 1)].astype(np.uint64) & _KEEP[np.clip(left, 0, 8)]


def pointer_sort(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte ranges by content, and where a new content begins in that order.

    Multikey quicksort with eight bytes as one character: each level sorts pointers by their next character and goes
    deeper only into equal runs of more than one pointer whose ranges go on. Ranges hold no zero byte.
    """
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    text8 = np.ndarray(len(text) + 8, ">u8", padded, strides=(1,))
    key = _keys(text8, start, stop - start)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    places, depth = np.arange(len(key)), 8
    while True:
        begin = new[places]
        follows = np.append(~begin[1:], False)  # the next pointer is in the same run
        deeper = (~begin | follows) & (stop[order[places]] - start[order[places]] > depth - 1)
        places = places[deeper]
        if not len(places):
            return order, new
        run = np.cumsum(new)[places]
        pointers = order[places]
        key = _keys(text8, start[pointers] + depth, stop[pointers] - start[pointers] - depth)
        ranked = np.lexsort((key, run))
        order[places] = pointers[ranked]
        key = key[ranked]
        new[places[1:]] |= (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        depth += 8


def _slice_counts(data: np.ndarray, edges: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray] | None:
    """Terms of a slice, and per (term, group): term number and group, occurrences, documents. ``group`` has one number per row."""
    text, local = _LOWER[data[edges[0] : edges[-1]]], edges - edges[0]
    solid = _LETTER[text]
    cut = np.zeros(len(text) + 1, bool)
    cut[local] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    del solid, cut, begins, ends
    if not len(start):
        return None
    # rows in the order of their groups, so that a run sorted by row is sorted by group too
    by_group = np.argsort(group, kind="stable")
    place = np.empty(len(group), np.int64)
    place[by_group] = np.arange(len(group))
    row = np.repeat(place, np.diff(np.searchsorted(start, local)))
    order, new = pointer_sort(text, start, stop)
    run = np.cumsum(new) - 1
    first = order[new]
    pairs = np.sort(run * len(group) + row[order])
    del run, row, order, new
    once = np.ones(len(pairs), bool)
    once[1:] = pairs[1:] != pairs[:-1]
    at = np.flatnonzero(once)
    occurrences = np.diff(np.append(at, len(pairs)))
    run, row = np.divmod(pairs[at], len(group))
    owner = group[by_group][row]
    change = np.ones(len(run), bool)
    change[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    cells = np.flatnonzero(change)
    size = stop[first] - start[first]
    offsets = np.zeros(len(first) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    letters = text[np.repeat(start[first] - offsets[:-1], size) + np.arange(offsets[-1])]
    terms = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(letters))
    return terms.take(pa.array(run[cells])), owner[cells], np.add.reduceat(occurrences, cells), np.diff(np.append(cells, len(run)))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, whole table.

    A term is a maximal run of ASCII letters and characters beyond ASCII, A-Z lower-cased and nothing else changed.
    Each row is a document. Null counts as the empty string in all three columns; further columns play no part.
    """
    bound_batches(docs.sparkSession)
    chosen = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])

    def run(batches):
        for batch in batches:
            langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
            data, edges = utf8(batch.column(2))
            for a, b in slices(edges, SLICE):
                found = _slice_counts(data, edges[a : b + 1], group[a:b])
                if found is None:
                    continue
                terms, owner, n, in_docs = found
                of_lang, of_source = np.divmod(owner, max(1, len(sources.dictionary)))
                columns = [langs.dictionary.take(pa.array(of_lang)), sources.dictionary.take(pa.array(of_source)), terms, pa.array(n), pa.array(in_docs)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    rows = chosen.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 * (count + 5) / (total + 5 * terms)) without overflow or rounding; 0 if there are no terms."""
    top = (count.cast("decimal(18,0)") + F.lit(5).cast("decimal(1,0)")) * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = total.cast("decimal(18,0)") + terms.cast("decimal(17,0)") * F.lit(5).cast("decimal(1,0)")
    return F.when(terms > 0, F.call_function("div", top, below) + 1).otherwise(F.lit(0)).cast("bigint")


def _tile_sums(tile: int):
    """Sums of |p_i - p_j| over terms, for the groups i of a tile and all groups j of the language.

    Rows come sorted by (lang, tile, header first). A header holds every group's share of a term it has not got; the
    other rows are terms with the shares of the groups that have them.
    """

    def run(batches):
        now, base, total, block = None, None, None, []

        def add():
            nonlocal block
            if block:
                shares = np.tile(base, (len(block), 1))
                for row, (places, values) in zip(shares, block, strict=True):
                    row[places] = values
                for i in range(len(total)):
                    total[i] += np.abs(shares - shares[:, now[1] * tile + i, None]).sum(axis=0)
                block = []

        def flush():
            add()
            i, j = np.indices(total.shape)
            i = i + now[1] * tile
            keep = i != j
            columns = [pa.array([now[0]] * int(keep.sum()), pa.string()), pa.array(i[keep].astype(np.int32)), pa.array(j[keep].astype(np.int32)), pa.array(total[keep])]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "i", "j", "apart"])

        for batch in batches:
            langs, tiles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = batch.column(2).offsets.to_numpy()
            places, values = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            edges = edges - edges[0]
            for k, key in enumerate(zip(langs, tiles, strict=True)):
                part = slice(edges[k], edges[k + 1])
                if key != now:
                    if now is not None:
                        yield flush()
                    now, base = key, np.zeros(part.stop - part.start, np.int64)
                    base[places[part]] = values[part]
                    total = np.zeros((min(tile, len(base) - key[1] * tile), len(base)), np.int64)
                    continue
                block.append((places[part].copy(), values[part].copy()))
                if len(block) * len(base) >= BLOCK_CELLS:
                    add()
        if now is not None:
            yield flush()

    return run


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Part ``pair``: each other source of the language and the sum of |p - q| over its kept terms, farthest first. Part
    ``term``: the ``top`` terms most over-represented against the whole language. Kept are terms in at least
    ``least_docs`` documents of the language; p is 1e9 times the share of a term smoothed by 5, rounded down, plus 1.
    Ties go by the item's UTF-8 bytes. A group without terms has pairs and no terms; a language without kept terms has
    pairs of value 0; a language with one source has no pairs; an empty table gives no rows.
    """
    counts = written(term_counts(docs, lang, source, text), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= least_docs)
    kept = written(kept.select("lang", "term", "n_lang"), "kept")
    used = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang"), "used")

    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang").agg(F.sum("n_lang").alias("lang_total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("bigint")
    groups = names.join(sums, ["lang", "source"], "left").join(whole, "lang", "left").fillna(0, ["total", "lang_total", "terms"])
    groups = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = written(groups.withColumn("unseen", _share(zero, F.col("total"), F.col("terms"))), "groups")

    shares = used.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    rises = shares.withColumn("value", F.col("p") - _share(F.col("n_lang"), F.col("lang_total"), F.col("terms"))).where("value > 0")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = rises.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    term = term.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    salts = max(LEAST_SALTS, -(-kept.count() // TERMS_PER_SALT))
    entries = F.sort_array(F.collect_list(F.struct("place", "share")))
    rows = shares.select("lang", "term", "place", F.col("p").alias("share")).groupBy("lang", "term").agg(entries.alias("e"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int")).withColumn("is_term", F.lit(1)).drop("term")
    heads = groups.select("lang", "place", F.col("unseen").alias("share")).groupBy("lang").agg(entries.alias("e"))
    sizes = heads.select("lang", F.sequence(F.lit(0), F.expr(f"(size(e) - 1) div {TILE}").cast("int")).alias("tiles"))
    heads = heads.select("lang", "e", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("is_term"))
    dealt = heads.unionByName(rows).join(sizes, "lang").withColumn("tile", F.explode("tiles"))
    dealt = dealt.repartition(salts, "salt").sortWithinPartitions("salt", "lang", "tile", "is_term")
    apart = dealt.select("lang", "tile", F.col("e.place").alias("places"), F.col("e.share").alias("shares")).mapInArrow(_tile_sums(TILE), "lang string, i int, j int, apart bigint")
    apart = apart.groupBy("lang", "i", "j").agg(F.sum("apart").alias("value"))
    left = groups.select("lang", "source", F.col("place").alias("i"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("j"))
    pair = apart.join(left, ["lang", "i"]).join(right, ["lang", "j"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pair = pair.withColumn("rank", F.row_number().over(ranked))
    return pair.unionByName(term)


#: The same table in DuckDB, by plain word lists.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS terms, sum(n_lang) AS total FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total FROM g),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (CAST(s.total AS HUGEINT) + 5 * v.terms) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n_lang + 5)) // (CAST(v.total AS HUGEINT) + 5 * v.terms) AS q
  FROM s JOIN k ON s.lang = k.lang JOIN v ON v.lang = s.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""

"""Near-copies by SuperMinHash signatures, banding, exact verification and union-find grouping.

Each shingle gives one random permutation of the signature's places, with ranks 0, 1, 2 ... plus a random fraction;
a place keeps the least value it is given. Ranks are drawn one after another for all shingles of many documents at
once, and a document stops as soon as every place holds a value below the next rank. Places are filled by correlated
draws, which makes the estimate less scattered than that of independent hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches, mix, slices, stream, utf8, word_hashes, written
from motorpool.llm.components import components

BANDS, ROWS = 24, 4
#: Shingles in a block of documents that are compared with another block, on average.
BLOCK_SHINGLES = 200_000
#: Ids of documents in candidate groups are broadcast to the scan of the texts up to this number (8 bytes each); above
#: it the texts are shuffled by id.
BROADCAST_IDS = 1_000_000
_WORD = stream(11, 64) | np.uint64(1)
_RANK = stream(13, 512)
_BAND = stream(17, 128)
_PLACE = stream(19, 512) | np.uint64(1)


def shingle_sets(data: np.ndarray, edges: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after another, and each row's place (n+1).

    Words are runs without ASCII white space, A-Z lower-cased. A row with fewer words than ``width`` has its whole
    sequence as one shingle, a row without words none.
    """
    words, at = word_hashes(data, edges)
    counts = np.diff(at)
    rows = len(counts)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    long = max(len(words) - width + 1, 0)
    h = np.zeros(long, np.uint64)
    for k in range(width):
        h += words[k : k + long] * _WORD[k]
    owner = np.repeat(np.arange(rows), counts)
    inside = (owner[:long] == owner[width - 1 :][:long]) if long else np.zeros(0, bool)
    h, who = mix(h[inside]), owner[:long][inside]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        total = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            total[has] += words[at[short[has]] + k] * _WORD[k]
        total = mix(total + counts[short].astype(np.uint64) * _WORD[width])
        h, who = np.concatenate([h, total]), np.concatenate([who, short])
    order = np.lexsort((h, who))
    h, who = h[order], who[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    h, who = h[fresh], who[fresh]
    return h, np.searchsorted(who, np.arange(rows + 1))


def signatures(sets: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash of each row: ``places`` values of rank and random fraction. Rows without elements keep the top value."""
    rows = len(at) - 1
    sig = np.full((rows, places), np.iinfo(np.uint64).max, np.uint64)
    flat = sig.reshape(-1)
    owner = np.repeat(np.arange(rows), np.diff(at))
    h, spots = sets, None
    for rank in range(places):
        if not len(h):
            break
        r = mix(h + _RANK[rank])
        step = ((r >> np.uint64(40)) * np.uint64(places - rank) >> np.uint64(24)).astype(np.int64) + rank
        if spots is None:
            place = step
        else:
            line = np.arange(len(h))
            place = spots[line, step].astype(np.int64)
            spots[line, step] = spots[:, rank]
        np.minimum.at(flat, owner * places + place, (np.uint64(rank) << np.uint64(40)) + (r & np.uint64((1 << 40) - 1)))
        worst = sig.max(axis=1) >= np.uint64(rank + 1) << np.uint64(40)
        more = worst[owner]
        if spots is None:  # only shingles that go on need their permutation kept
            h, owner, step = h[more], owner[more], step[more]
            spots = np.broadcast_to(np.arange(places, dtype=np.uint16), (len(h), places)).copy()
            spots[np.arange(len(h)), step] = 0
        elif not more.all():
            h, owner, spots = h[more], owner[more], spots[more]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sig), _BAND[b])
        for r in range(rows):
            key = mix(key + sig[:, b * rows + r] * _PLACE[r])
        out[:, b] = key
    return out


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def sketches(docs: DataFrame, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """(doc, n_shingles, digest_a, digest_b, bands): the digests are sums over two 64-bit codes of the whole set."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, edges = utf8(batch.column(1))
            for first, last in slices(edges):
                sets, at = shingle_sets(data, edges[first : last + 1], width)
                size = np.diff(at)
                sums = []
                for salt in stream(23, 2):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets + salt), dtype=np.uint64)])
                    sums.append(pa.array((total[at[1:]] - total[at[:-1]]).view(np.int64)))
                keys = band_keys(signatures(sets, at, bands * rows), bands, rows)
                has = np.where(size > 0, bands, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(size.astype(np.int64)), *sums, _lists(keys[size > 0].reshape(-1), np.concatenate([[0], np.cumsum(has)]))],
                    names=["doc", "n_shingles", "digest_a", "digest_b", "bands"],
                )

    return docs.select("doc", text).mapInArrow(run, "doc bigint, n_shingles bigint, digest_a bigint, digest_b bigint, bands array<bigint>")


def full_sets(docs: DataFrame, text: str, width: int) -> DataFrame:
    """(doc, shingles): the whole sorted set as packed 64-bit integers."""

    def run(batches):
        for batch in batches:
            data, edges = utf8(batch.column(1))
            for first, last in slices(edges):
                sets, at = shingle_sets(data, edges[first : last + 1], width)
                raw = sets.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([raw[8 * i : 8 * j] for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())],
                    names=["doc", "shingles"],
                )

    return docs.select("doc", text).mapInArrow(run, "doc bigint, shingles binary")


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    return run


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough."""
    left = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(left, "b").join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left")), "a")
    return joined.select("a", "b", "left", "right").mapInArrow(_verify(percent), "a bigint, b bigint")


def _between(percent: int):
    """Links between two blocks of one group, one for each left document and other component."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list[int], list[int]] = ([], [])
        if left.num_rows and right.num_rows:
            sides = [left, right]
            ids = [t.column("doc").to_numpy() for t in sides]
            parts = [t.column("part").to_numpy() for t in sides]
            sets = [[np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")] for t in sides]
            sizes = [np.array([len(x) for x in own]) for own in sets]
            every = [np.concatenate(own) for own in sets]
            shared = np.intersect1d(*every)  # a shingle of one side only counts for no pair
            both = np.zeros((len(ids[0]), len(ids[1])), np.int64)
            rows = [np.repeat(np.arange(len(x)), x) for x in sizes]
            for first in range(0, len(shared), 4096):
                some = shared[first : first + 4096]
                grids = []
                for k in (0, 1):
                    at = np.minimum(np.searchsorted(some, every[k]), len(some) - 1)
                    hit = some[at] == every[k]
                    grid = np.zeros((len(ids[k]), len(some)), np.float32)
                    grid[rows[k][hit], at[hit]] = 1
                    grids.append(grid)
                both += (grids[0] @ grids[1].T).astype(np.int64)
            union = sizes[0][:, None] + sizes[1][None, :] - both
            x, y = np.nonzero((100 * both >= percent * union) & (parts[0][:, None] != parts[1][None, :]))
            _, one = np.unique(np.stack([ids[0][x], parts[1][y]]), axis=1, return_index=True)
            found = (ids[0][x[one]], ids[1][y[one]])
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def between_parts(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between documents of one group (``lead``) that are in different components so far.

    Of two such documents one at least is outside the component of the group's leader; only these are compared, in
    blocks of bounded size, with all members of the group. Pairs stay inside a block; only links leave it.
    """
    rest = grouped.where("part <> lead_part")
    block = lambda rows, name: rows.groupBy("lead").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias(name))
    sizes = block(rest, "q").join(block(grouped, "m"), "lead")
    full = grouped.join(sizes, "lead").join(sets, "doc")
    spot = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    asked = full.where("part <> lead_part").select("lead", spot("q").alias("qb"), every("m").alias("mb"), "doc", "part", "shingles")
    member = full.select("lead", every("q").alias("qb"), spot("m").alias("mb"), "doc", "part", "shingles")
    member = member.toDF(*member.columns)  # fresh names: both sides come from one table
    keys = ["lead", "qb", "mb"]
    return asked.groupBy(*keys).cogroup(member.groupBy(*keys)).applyInArrow(_between(percent), "a bigint, b bigint")


def near_copies(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per document: its integer id, ``n_shingles``, ``component_id`` (smallest id reachable over links), ``kept``.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``width``-word shingles. Every
    link is confirmed on whole sets. A pair at the limit shares no band with probability (1 - 0.8^4)^24 < 4e-6.

    Equal sets are folded into one representative first. In each bucket all members are compared with the member
    that meets most others over all bands, its leader. What is not in the leader's component then is compared with
    all others under this leader, in bounded blocks, so no link between different components is passed over.

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. Rows that repeat an
    id are one document as long as their texts agree; rows without an id are left out. Extra columns are not read.
    """
    known = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    sketch = written(sketches(known, "text", width, bands, rows), "sketch")
    full = sketch.where("n_shingles > 0")
    same = ["n_shingles", "digest_a", "digest_b"]
    # one representative for equal sets; the partial minimum runs before the shuffle
    reps = written(full.groupBy(*same).agg(F.min("doc").alias("rep")), "reps")
    heads = full.join(reps.select(F.col("rep").alias("doc")), "doc", "left_semi").dropDuplicates(["doc"])
    row = heads.select("doc", "n_shingles", F.explode("bands").alias("bucket"))
    crowded = row.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = written(row.join(crowded, "bucket"), "members")
    # the member that meets most others leads its buckets: copies then compare with their original
    weight = member.groupBy("doc").agg(F.sum("n").alias("w"))
    ranked = member.join(weight, "doc").select("bucket", "doc", "n_shingles", F.struct("w", (-F.col("doc")).alias("low")).alias("lead"))
    lead = ranked.groupBy("bucket").agg(F.max("lead").alias("lead")).select("bucket", (-F.col("lead.low")).alias("lead"))
    size = heads.select(F.col("doc").alias("lead"), F.col("n_shingles").alias("size_lead"))
    group = written(member.join(lead, "bucket").where("doc <> lead").select("doc", "n_shingles", "lead").distinct().join(size, "lead"), "groups")
    alike = f"100 * least(n_shingles, size_lead) >= {percent} * greatest(n_shingles, size_lead)"
    wanted = written(group.select("doc").union(group.select("lead")).distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = written(full_sets(known.join(wanted, "doc", "left_semi"), "text", width), "sets")
    links = written(confirm(group.where(alike).select(F.col("doc").alias("a"), F.col("lead").alias("b")), sets, percent), "links")
    tree = written(components(links), "tree")
    part = lambda name, label: tree.select(F.col("node").alias(name), F.col("root").alias(label))
    placed = group.join(part("doc", "part"), "doc", "left").join(part("lead", "lead_part"), "lead", "left")
    placed = placed.select("doc", "lead", "n_shingles", F.coalesce("part", "doc").alias("part"), F.coalesce("lead_part", "lead").alias("lead_part"))
    late = written(between_parts(written(placed, "placed"), sets, percent), "links")
    if late.head(1):
        tree = written(components(links.union(late)), "tree")
    rooted = reps.join(tree.withColumnRenamed("node", "rep"), "rep", "left").select(*same, F.coalesce("root", "rep").alias("component"))
    ids = sketch.select("doc", *same).dropDuplicates(["doc"])
    out = ids.join(rooted, same, "left").select(
        F.col("doc").alias(id_col), "n_shingles", F.coalesce("component", "doc").alias("component_id")
    )
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))

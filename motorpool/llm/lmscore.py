"""LM scoring by cross-entropy difference of two matched bigram models.

Both models share one vocabulary, the words of the whole corpus: no word is unknown to one and known to the other, and
words and pairs are counted one by one, however many there are. The larger side is scaled to the tokens of the smaller
one, so smoothing weighs alike in both. A document's own counts are taken out of its side before it is scored.

Documents are packed into chunks of bounded size, where they stand. Only ids are joined to the targets; each chunk gets
the places of its targets, and no text moves for it. A chunk counts its words and pairs and sends them, split by ranges of
their 64-bit hashes, to where each range is summed over all chunks. Of the sums it gets back those of words and pairs
that other chunks hold too; all others it has itself. A common word or pair is thus one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import LONG_ROWS, bound_batches, grouped, mix, return_memory, slices, stream, utf8, word_hashes, written_alone

#: Words that smoothing allows for at least; a corpus with more words allows for all of them.
WORDS = 1 << 16
#: Weight of the pair estimate against the single word, and what is added to each word's count.
PAIR_WEIGHT, ADDED = 0.5, 0.1
#: Bytes of text in a chunk and behind a range of hashes, and ranges at least.
CHUNK, RANGE, RANGES = 1 << 22, 1 << 22, 256
#: Bytes of text hashed at once, and ranges in a batch: two Python workers share what the executor's heap leaves.
_SLICE, _SENT = 1 << 18, 32
#: Words scored at once, one row at least.
_TOKENS = 1 << 16
_PAIR = stream(31, 2) | np.uint64(1)
_PACKED = "chunk bigint, data binary, ends binary"
_COUNTS = "range bigint, chunk bigint, words binary, word_n binary, pairs binary, pair_n binary"
_SUMS = "chunk bigint, range bigint, words binary, word_n binary, pairs binary, pair_n binary, distinct bigint, background bigint, target bigint"


def _written(df: DataFrame, label: str) -> DataFrame:
    return written_alone(df, label, **LONG_ROWS)


def _bytes(values: np.ndarray) -> bytes:
    """Eight-byte numbers with their high bytes side by side, which compresses well."""
    return np.ascontiguousarray(values.reshape(-1)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(data: pa.Scalar, kind: type, width: int = 1) -> np.ndarray:
    flat = np.ascontiguousarray(np.frombuffer(data.as_buffer(), np.uint8).reshape(8, -1).T).view(kind).reshape(-1)
    return flat.reshape(-1, width) if width > 1 else flat


def _tokens(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word, of the word before (0 before the first) and of the pair of both, and the word's row."""
    found = [word_hashes(data, edges[first : last + 1]) for first, last in slices(edges, _SLICE)]
    here = np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in found)])
    number = np.concatenate([np.zeros(0, np.int64), *(np.diff(at) for _, at in found)])
    at = np.append(0, np.cumsum(number))
    before = np.zeros(len(here), np.uint64)
    before[1:] = here[:-1]
    before[at[:-1][number > 0]] = 0
    return here, before, mix(here * _PAIR[0] + mix(before * _PAIR[1])), np.repeat(np.arange(len(number), dtype=np.int32), number)


class _Chunk:
    """The words and pairs of a chunk: sorted distinct hashes, the place of each word's own among them, and counts.

    ``word_n`` has the columns word (background, target) and context (background, target), ``pair_n`` the pair's two.
    """

    def __init__(self, data: np.ndarray, edges: np.ndarray, side: np.ndarray):
        here, before, pair, self.row = _tokens(data, edges)
        n, self.mine = len(here), side[self.row].astype(np.int8)
        self.words, places = np.unique(np.concatenate([here, before[before == 0][:1]]), return_inverse=True)
        self.here = places[:n].astype(np.int32)
        del places
        self.before = np.zeros(n, np.int32)  # the start of a text is hash 0, which sorts first
        self.before[1:] = self.here[:-1]
        self.before[before == 0] = 0
        del here, before
        self.pairs, places = np.unique(pair, return_inverse=True)
        self.pair = places.astype(np.int32)
        del places, pair
        self.word_n = np.concatenate([_count(self.here, self.mine, len(self.words)), _count(self.before, self.mine, len(self.words))], axis=1)
        self.pair_n = _count(self.pair, self.mine, len(self.pairs))


def _count(key: np.ndarray, side: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(key.astype(np.int64) * 2 + side, minlength=2 * size).reshape(size, 2)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of hashes begins among sorted ``keys``, and the end."""
    step = (1 << 64) // ranges + 1
    return np.append(np.searchsorted(keys, np.arange(ranges, dtype=np.uint64) * np.uint64(step)) if ranges > 1 else 0, len(keys))


def _opened(table: pa.Table | pa.RecordBatch, k: int) -> _Chunk:
    data, ends = (table.column(c)[k].as_buffer() for c in ("data", "ends"))
    edges, side = np.append(0, np.frombuffer(ends, np.int64)), np.zeros(ends.size // 8, bool)
    if (places := table.column("targets")[k]).is_valid:
        side[places.values.to_numpy()] = True
    return _Chunk(np.frombuffer(data, np.uint8) if data.size else np.zeros(0, np.uint8), edges, side)


def pack(known: DataFrame, kind: str, size: int = CHUNK) -> DataFrame:
    """Rows (id, text) as chunks of about ``size`` bytes of text, one text at least."""

    def run(batches):
        return_memory()
        task, number, held, weight = TaskContext.get().partitionId(), 0, [], 0

        def chunk() -> pa.RecordBatch:
            ids = pa.concat_arrays([i for i, _, _ in held])
            ends = np.cumsum(np.concatenate([n for _, _, n in held]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + number]), pa.array([b"".join(t.tobytes() for _, t, _ in held)], pa.binary()), pa.array([ends.astype(np.int64).tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([int(ends[-1])]),
                ],
                names=["chunk", "data", "ends", "ids", "size"],
            )

        for batch in batches:
            data, edges = utf8(batch.column(1))
            for first, last in slices(edges):
                held.append((batch.column(0).slice(first, last - first), data[edges[first] : edges[last]], np.diff(edges[first : last + 1])))
                weight += int(edges[last] - edges[first])
                if weight >= size:
                    yield chunk()
                    number, held, weight = number + 1, [], 0
        if held:
            yield chunk()

    return known.mapInArrow(run, f"{_PACKED}, ids array<{kind}>, size bigint")


def sided(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """``packed`` with ``targets``, the places of documents whose id is in ``ids`` (_t). Places are broadcast by chunk:
    four bytes for each target document."""
    placed = packed.select("chunk", F.posexplode("ids").alias("place", "_t"))
    places = placed.join(ids, "_t", "left_semi").groupBy("chunk").agg(F.collect_list("place").alias("targets"))
    return packed.join(F.broadcast(places), "chunk", "left")


def counts(packed: DataFrame, ranges: int) -> DataFrame:
    """Rows (range, chunk): the chunk's words and pairs in a range of hashes, with their counts."""

    def run(batches):
        return_memory()
        for batch in batches:
            for k, number in enumerate(batch.column(0).to_pylist()):
                own = _opened(batch, k)
                words, pairs = _cuts(own.words, ranges), _cuts(own.pairs, ranges)
                some = np.flatnonzero((np.diff(words) > 0) | (np.diff(pairs) > 0))
                for at in (some[i : i + _SENT] for i in range(0, len(some), _SENT)):
                    w, p = ([slice(cuts[r], cuts[r + 1]) for r in at] for cuts in (words, pairs))
                    columns = [[_bytes(x[c]) for c in cut] for cut, x in ((w, own.words), (w, own.word_n), (p, own.pairs), (p, own.pair_n))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array([number] * len(at)), *(pa.array(x, pa.binary()) for x in columns)],
                        names=["range", "chunk", "words", "word_n", "pairs", "pair_n"],
                    )

    return packed.mapInArrow(run, _COUNTS)


def _summed(keys: list[np.ndarray], number: list[np.ndarray]) -> tuple[Iterator[tuple[bytes, bytes]], np.ndarray]:
    """Per chunk the bits of its keys that other chunks hold too and the sums of these; and the sums of all keys."""
    distinct, place, chunks = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    total = np.add.reduceat(np.concatenate(number)[order], np.append(0, np.cumsum(chunks)[:-1]), axis=0) if len(distinct) else np.concatenate(number)

    def parts():
        at = 0
        for own in keys:
            mine = place[at : at + len(own)]
            shared = chunks[mine] > 1
            yield np.packbits(shared).tobytes(), _bytes(total[mine[shared]])
            at += len(own)

    return parts(), total


def sums(counted: DataFrame) -> DataFrame:
    """Rows (chunk, range) with what :func:`_summed` returns, and per range a row without chunk: distinct words, and words of each side."""

    def run(batches):
        return_memory()
        for table in grouped(batches):
            ranges, chunks = table.column("range").to_numpy(), table.column("chunk").to_pylist()
            cuts = np.append(np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])), len(ranges))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(a, b - a)
                words, total = _summed([_numbers(x, np.uint64) for x in part.column("words")], [_numbers(x, np.int64, 4) for x in part.column("word_n")])
                pairs, _ = _summed([_numbers(x, np.uint64) for x in part.column("pairs")], [_numbers(x, np.int64, 2) for x in part.column("pair_n")])
                rows = zip(*((*w, *p) for w, p in zip(words, pairs, strict=True)), strict=True)
                whole = ((total[:, :2].sum(axis=1) > 0).sum(), *total[:, :2].sum(axis=0))
                blank = [None] * (b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*chunks[a:b], None], pa.int64()), pa.array([int(ranges[a])] * (b - a + 1), pa.int64()),
                        *(pa.array([*x, None], pa.binary()) for x in rows), *(pa.array([*blank, int(x)], pa.int64()) for x in whole),
                    ],
                    names=["chunk", "range", "words", "word_n", "pairs", "pair_n", "distinct", "background", "target"],
                )

    return counted.repartition("range").sortWithinPartitions("range").mapInArrow(run, _SUMS)


def _per_row(row: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
    """How often each word's key stands in its own row."""
    _, inverse, number = np.unique(row.astype(np.int64) * width + key, return_inverse=True, return_counts=True)
    return number[inverse]


def losses(own: _Chunk, word_n: np.ndarray, pair_n: np.ndarray, totals: np.ndarray, vocabulary: int, n: int) -> list[np.ndarray]:
    """Sum over each row of its words' losses under the background and the target model, in nats; the counts are those of the corpus."""
    out = [np.zeros(n), np.zeros(n)]
    at = np.searchsorted(own.row, np.arange(n + 1))
    for first, last in slices(at, _TOKENS):
        some = slice(at[first], at[last])
        for total, loss in zip(out, _losses(own, some, word_n, pair_n, totals, vocabulary), strict=True):
            total[first:last] = np.bincount(own.row[some] - first, loss, last - first)
    return out


def _losses(own: _Chunk, some: slice, word_n: np.ndarray, pair_n: np.ndarray, totals: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """Losses of ``some`` words, those of whole rows."""
    width = len(own.words) + len(own.pairs)
    row, here, before, pairs, side = own.row[some], own.here[some], own.before[some], own.pair[some], own.mine[some]
    self_n = [_per_row(row, key, width) for key in (here, before, pairs)] if len(row) else [row] * 3
    words = np.bincount(row)[row] if len(row) else row
    small = max(min(totals), 1.0)
    out = []
    for k in (0, 1):
        mine = (side == k).astype(np.float64)
        scale = small / max(totals[k], 1.0)
        word = (word_n[here, k] - mine * self_n[0]) * scale
        context = word_n[before, 2 + k] - mine * self_n[1]
        pair = pair_n[pairs, k] - mine * self_n[2]
        single = (word + ADDED) / ((totals[k] - mine * words) * scale + ADDED * vocabulary)
        joint = np.where(context > 0, pair / np.maximum(context, 1), single)
        out.append(-np.log(PAIR_WEIGHT * joint + (1 - PAIR_WEIGHT) * single))
    return out


def _filled(counts: np.ndarray, cuts: np.ndarray, ranges: list[int], bits: pa.ChunkedArray, totals: pa.ChunkedArray) -> np.ndarray:
    """A chunk's counts with the sums of the corpus in place of those that other chunks share."""
    for r, own, total in zip(ranges, bits, totals, strict=True):
        part = counts[cuts[r] : cuts[r + 1]]
        part[np.unpackbits(np.frombuffer(own.as_buffer(), np.uint8), count=len(part)).astype(bool)] = _numbers(total, np.int64, counts.shape[1])
    return counts


def score(docs: DataFrame, targets: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: the id, ``n_tokens``, ``ce_target``, ``ce_background`` (nats per word) and ``ce_diff``
    (target less background: the lower, the more like the target).

    ``targets`` holds the ids of the target documents; repeats and nulls in it count for nothing. All other documents,
    those without an id too, are the background. Null and empty texts have no words and differences of 0. Repeated
    rows are counted and scored as often as they stand there; extra columns are not read.
    """
    bound_batches(docs.sparkSession, "4m")
    kind = docs.schema[id_col].dataType.simpleString()
    ids = targets.select(F.col(id_col).alias("_t")).where("_t is not null").distinct()
    known = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    written_chunks = _written(pack(known, kind), "packed")
    packed = sided(written_chunks, ids).select("chunk", "data", "ends", "targets", "ids", "size")
    ranges = max(RANGES, -(-(written_chunks.agg(F.sum("size")).first()[0] or 0) // RANGE))
    summed = _written(sums(counts(packed.drop("ids", "size"), ranges)), "sums")
    whole = summed.where("chunk is null").agg(F.sum("distinct"), F.sum("background"), F.sum("target")).first()
    vocabulary, totals = max(WORDS, whole[0] or 0), [float(whole[1] or 0), float(whole[2] or 0)]

    def run(batches):
        return_memory()
        for table in grouped(batches):
            chunk = table.column("chunk").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])), len(chunk))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(a, b - a)
                texts, sent = part.filter(pc.is_valid(part.column("data"))), part.filter(pc.is_null(part.column("data")))
                own, n = _opened(texts, 0), len(texts.column("ids")[0])
                at = sent.column("range").to_pylist()
                word_n = _filled(own.word_n, _cuts(own.words, ranges), at, sent.column("words"), sent.column("word_n"))
                pair_n = _filled(own.pair_n, _cuts(own.pairs, ranges), at, sent.column("pairs"), sent.column("pair_n"))
                low, high = losses(own, word_n, pair_n, totals, vocabulary, n)
                count = np.bincount(own.row, minlength=n)
                background, target = low / np.maximum(count, 1), high / np.maximum(count, 1)
                yield pa.RecordBatch.from_arrays(
                    [texts.column("ids")[0].values, pa.array(count), pa.array(target), pa.array(background), pa.array(target - background)],
                    names=[id_col, "n_tokens", "ce_target", "ce_background", "ce_diff"],
                )

    sent = summed.where("chunk is not null").drop("distinct", "background", "target")
    both = packed.drop("size").unionByName(sent, allowMissingColumns=True)
    out = f"{id_col} {kind}, n_tokens bigint, ce_target double, ce_background double, ce_diff double"
    return both.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, out)

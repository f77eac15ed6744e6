"""Packing of tokenised texts into sequences of a fixed length: bounded-space online best-fit.

Texts become pieces of at most ``capacity`` tokens. Full pieces are sequences of their own. The others are dealt by hash
into shards of about ``SHARD`` pieces; each shard arrives longest first at a packer with ``OPEN_BINS`` open bins, so a
task holds one list of bins whatever the size of the table, and shards are independent of each other.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import bound_batches, utf8, written

OPEN_BINS = 4096
SHARD = 8192
MEMO_ENTRIES = 400_000
LONGEST_KEPT = 64
WORDS_A_CALL = 2000
SEGMENT = 2 << 20
OUT_BYTES = 4 << 20
_TAIL = b".,;:!?&#$*%)-"
_BLANK = [b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"]


class WordIds(dict):
    """Ids of runs of bytes without ASCII white space, as little-endian 32-bit numbers, remembered by the bytes.

    Cutting at ASCII white space changes no id: the tokenizer drops it and its normal form composes nothing across it.
    A run of Latin letters with marks behind it is looked up in two parts, its letters in lower case, which are the
    tokenizer's own steps. Such words are encoded many in one call; each ends where an id has the end-of-word mark.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        self._encode = loaded.encode
        self._last = np.zeros(loaded.get_vocab_size(), bool)
        mark = getattr(loaded.model, "end_of_word_suffix", None)
        for token, number in loaded.get_vocab().items():
            self._last[number] = bool(mark) and token.endswith(mark)
        self._joined = bool(mark)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_words(self, words: list[bytes]) -> None:
        """Lower-case words of Latin letters only."""
        for k in range(0, len(words), WORDS_A_CALL):
            part = words[k : k + WORDS_A_CALL]
            ids = self._ids(b" ".join(part).decode())
            stops = (np.flatnonzero(self._last[ids]) + 1) * 4
            if self._joined and len(stops) == len(part):
                packed, first = ids.tobytes(), 0
                for word, stop in zip(part, stops.tolist(), strict=True):
                    self[word] = packed[first:stop]
                    first = stop
            else:
                for word in part:
                    self[word] = self._ids(word.decode()).tobytes()

    def learn(self, runs: set[bytes]) -> None:
        """Add ``runs``, none of which is known."""
        composed, words = [], set()
        for run in runs:
            letters = run.rstrip(_TAIL)
            if letters.isalpha():  # of bytes: ASCII letters only
                stem = letters.lower()
            else:
                text = letters.decode("utf-8", "replace")
                if not text.isalpha() or max(text) >= "Ā":
                    self[run] = self._ids(run.decode("utf-8", "replace")).tobytes()
                    continue
                stem = text.lower().encode()
            if stem not in self:
                words.add(stem)
            if stem != run:
                composed.append((run, stem, run[len(letters) :]))
        self._learn_words(list(words))
        for run, stem, tail in composed:
            if tail not in self:
                self[tail] = self._ids(tail.decode()).tobytes()
            self[run] = self[stem] + self[tail]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. Beyond ``MEMO_ENTRIES`` only what these texts use stays in memory."""
        runs = [_lower(text).split() for text in texts]
        used = set().union(*runs)
        self.learn(used - self.keys())
        out = [b"".join(map(self.__getitem__, r)) for r in runs]
        if len(self) > MEMO_ENTRIES:
            kept = {run: self[run] for run in used if len(run) <= LONGEST_KEPT}
            self.clear()
            self.update(kept)
        return out


def _lower(text: bytes) -> bytes:
    """ASCII capitals made small, as the tokenizer does later; not beside accents that combine (a capital and its small
    letter may compose differently) nor where a special token's name could arise."""
    return text if b"\xcc" in text or b"<|" in text else text.lower()


_WORDS: dict[str, WordIds] = {}


def _segments(text: bytes) -> Iterator[bytes]:
    """Parts of about ``SEGMENT`` bytes that end at white space, so a very long text is never one list of words."""
    first = 0
    while len(text) - first > SEGMENT:
        stop = max(text.rfind(b, first, first + SEGMENT) for b in _BLANK)
        if stop <= first:
            ends = [p for b in _BLANK if (p := text.find(b, first + SEGMENT)) >= 0]
            if not ends:
                break
            stop = min(ends)
        yield text[first:stop]
        first = stop
    yield text[first:]


def text_ids(words: WordIds, texts: Iterator[bytes], end: bytes = b"") -> Iterator[bytes]:
    """The ids of each text and then ``end``, in order; about ``SEGMENT`` bytes are encoded at once."""
    parts, owners, size, whole, done = [], [], 0, [], 0

    def encoded():
        nonlocal parts, owners, size, whole, done
        for owner, ids in zip(owners, words.encode(parts), strict=True):
            while done < owner:
                yield b"".join(whole) + end
                whole, done = [], done + 1
            whole.append(ids)
        parts, owners, size = [], [], 0

    n = 0
    for text in texts:
        for part in _segments(text):
            parts.append(part)
            owners.append(n)
            size += len(part)
            if size >= SEGMENT:
                yield from encoded()
        n += 1
    yield from encoded()
    if n:
        yield b"".join(whole) + end


def pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, piece, start, length, ids): every text's ids and then ``end_id``, cut into runs of ``capacity``.

    ``ids`` is binary, little-endian unsigned 32-bit. ``row`` numbers all pieces. A null or empty text is one piece
    with ``end_id`` alone. Rows with a null or repeated id are texts like any other; further columns play no part; an
    empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches):
        words = _WORDS.setdefault(path, WordIds(path))
        count = TaskContext.get().partitionId() << 36
        for batch in batches:
            data, edges = utf8(batch.column(1))
            source, starts, ids, size = [], [], [], 0
            raw = data.data
            texts = (raw[edges[k] : edges[k + 1]].tobytes() for k in range(batch.num_rows))
            for k, packed in enumerate(text_ids(words, texts, end)):
                for at in range(0, len(packed), width):
                    source.append(k)
                    starts.append(at // 4)
                    ids.append(packed[at : at + width])
                size += len(packed)
                if size >= OUT_BYTES or k == batch.num_rows - 1:
                    start = np.array(starts, np.int64)
                    number = np.arange(count, count + len(ids))
                    length = np.array([len(i) // 4 for i in ids], np.int64)
                    columns = [batch.column(0).take(pa.array(source)), pa.array(number), pa.array((start // capacity).astype(np.int32)), pa.array(start), pa.array(length), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc", "row", "piece", "start", "length", "ids"])
                    count, source, starts, ids, size = count + len(ids), [], [], [], 0

    kind = docs.schema[doc].dataType.simpleString()
    chosen = docs.select(F.col(doc).alias("doc"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc {kind}, row bigint, piece int, start bigint, length bigint, ids binary")


class Packer:
    """Online best-fit with at most ``open_bins`` open bins.

    A bitset over free space finds the fullest bin that still takes a piece. If none does and all bins are open, the
    fullest closes. A full bin closes by itself.
    """

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self._by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._bits = self._open = self.bins = 0

    def _take(self, free: int) -> int:
        found = self._by_free[free].pop()
        if not self._by_free[free]:
            self._bits ^= 1 << free
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it for a piece of 1 to ``capacity`` tokens."""
        fits = self._bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            if self._open == self.open_bins:
                self._take((self._bits & -self._bits).bit_length() - 1)
                self._open -= 1
            chosen, free = self.bins, self.capacity
            self.bins += 1
            self._open += 1
        left = free - length
        if left:
            self._by_free[left].append(chosen)
            self._bits |= 1 << left
        else:
            self._open -= 1
        return chosen, self.capacity - free


def place(parts: DataFrame, capacity: int = 2048, open_bins: int = OPEN_BINS, shard: int = SHARD) -> DataFrame:
    """``parts`` with sequence_id and offset. ``parts`` is a stored table with a unique ``row`` and a ``length`` of 1 to ``capacity``.

    The number of shards follows the number of pieces that are not full; it is the only figure the driver sees.
    Pieces of equal length go by ``row``, so the result does not depend on the order in which a shuffle delivers them.
    """
    rest = parts.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard))
    names = rest.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)

    def run(batches):
        last, packer = None, None
        for batch in batches:
            numbers, lengths = batch.column(0).to_pylist(), batch.column(names.index("length") + 1).to_pylist()
            sequence, offset = np.empty(len(numbers), np.int64), np.empty(len(numbers), np.int64)
            for k, (number, length) in enumerate(zip(numbers, lengths, strict=True)):
                if number != last:
                    last, packer = number, Packer(capacity, open_bins)
                chosen, offset[k] = packer.place(length)
                sequence[k] = ((number << 24) + chosen) * 2
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    dealt = rest.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("_shard"), *names)
    dealt = dealt.repartition("_shard").sortWithinPartitions("_shard", F.desc("length"), "row")
    full = parts.where(F.col("length") == capacity).select(*names, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return dealt.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint").unionByName(full)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, ids: bool = True, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All texts as pieces with their places in sequences: doc, row, piece, start, length, ids (or ids_crc32), sequence_id, offset.

    With ``ids=False`` only the CRC-32 of each piece's ids is kept. Rules for odd rows are those of ``pieces``.
    """
    cut = pieces(docs, path, capacity, end_id, doc, text)
    if not ids:
        cut = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(written(cut, "pieces"), capacity)

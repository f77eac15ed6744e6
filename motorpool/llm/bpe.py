"""Byte-level BPE encoding and decoding.

A vocabulary entry that is met as a whole pre-token is found by a minimal perfect hash over the vocabulary; every
other pre-token is merged with a heap over a doubly linked list of its bytes, which stays n log n for any length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from motorpool.llm.common import bound_batches, mix

#: Parts of texts, and pre-tokens, that a worker remembers; a matter of speed only, results never depend on it.
MEMO = 600_000
#: Longer ones are not remembered, so the memory of a worker is bounded.
MEMO_CHARS = 64
#: Characters encoded together, one text at least.
GROUP_CHARS = 1 << 20

_BESIDE = regex.compile(r"\s | \s").search
_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for code, rank in pairs:
        tokens[int(rank)] = base64.b64decode(code)
    return tokens


class PerfectIndex:
    """Minimal perfect hash over distinct byte strings: levels of bit arrays, each holding the keys that met no
    other key there; a key's number is the count of set bits before its own."""

    def __init__(self, keys: list[bytes], gamma: float = 2.0):
        self.sizes, bits = [], []
        left = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys share a 64-bit hash")
        while len(left):
            size = max(64, int(gamma * len(left)))
            slot = (mix(left + np.uint64(len(self.sizes))) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            self.sizes.append(size)
            bits.append(alone)
            left = left[~alone[slot]]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.before = np.concatenate([[0], np.cumsum(self.bits)]).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each key; an unknown key gets the number of some key or -1, so compare the key itself."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (mix(hashes[open_] + np.uint64(level)) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.before[at[hit]]
            open_ = open_[~hit]
        return out


class Codec:
    """Encoder and decoder over one rank list; ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.cut = regex.compile(pattern).findall
        self.ranks = {t: r for r, t in enumerate(tokens)}
        self.byte = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.index = PerfectIndex(tokens)
        order = self.index.numbers(np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64))
        self.rank_of = np.zeros(len(tokens), np.int64)
        self.rank_of[order] = np.arange(len(tokens))
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Join neighbours, lowest rank first and leftmost among equals, until no pair is in the vocabulary."""
        get, n = self.ranks.get, len(word)
        if n == 1:
            return (self.byte[word[0]],)
        parts = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n))
        pair = [get(word[i : i + 2], -1) for i in range(n - 1)]  # rank of the pair that begins here
        pair.append(-1)
        heap = [(r << 32) + i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            if pair[i] != rank:
                continue  # one of the two has been joined meanwhile
            j = after[i]
            parts[i] = joined = parts[i] + parts[j]
            pair[j] = -1
            after[i] = k = after[j]
            before[k] = i
            if k < n and (r := get(joined + parts[k], -1)) >= 0:
                pair[i] = r
                heappush(heap, (r << 32) + i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                pair[h] = r = get(parts[h] + joined, -1)
                if r >= 0:
                    heappush(heap, (r << 32) + h)
        out, i, ranks = [], 0, self.ranks
        while i < n:
            out.append(ranks[parts[i]])
            i = after[i]
        return tuple(out)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens: whole entries by the perfect hash, the others merged."""
        raw = [w.encode("utf-8") for w in words]
        found = self.index.numbers(np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw)))
        tokens, out = self.tokens, {}
        for w, b, rank in zip(words, raw, self.rank_of[np.maximum(found, 0)].tolist(), strict=True):
            out[w] = _PACK[1](rank) if tokens[rank] == b else self.pack(self.merge(b))
        return out

    @staticmethod
    def pack(ids: tuple[int, ...]) -> bytes:
        n = len(ids)
        return _PACK[n](*ids) if n < len(_PACK) else np.array(ids, "<u4").tobytes()

    def pieces(self, text: str) -> list[str]:
        """Parts that no pre-token reaches across: a lone space between other characters always begins one.

        Where white space stands beside a space the whole text is one part.
        """
        if _BESIDE(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        parts = [self.pieces(t) for t in texts]
        memo, words = self.memo, self.words
        new = {p for own in parts for p in own if p not in memo}
        if not new:
            return [b"".join(map(memo.__getitem__, own)) for own in parts]
        cut = {p: self.cut(p) for p in new}
        fresh = self.learn(list({w for own in cut.values() for w in own if w not in words}))
        known = _Both(fresh, words)
        made = {p: b"".join([known[w] for w in own]) for p, own in cut.items()}
        both = _Both(made, memo)
        out = [b"".join([both[p] for p in own]) for own in parts]
        for kept, more in ((words, fresh), (memo, made)):
            short = {k: v for k, v in more.items() if len(k) <= MEMO_CHARS}
            if len(kept) + len(short) > MEMO:
                kept.clear()
            kept.update(short)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class _Both(dict):
    """``first`` with a fall-back, without copying either."""

    def __init__(self, first: dict, rest: dict):
        super().__init__(first)
        self.rest = rest

    def __missing__(self, key):
        return self.rest[key]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and rank file."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The column's texts, null as empty, in runs of about GROUP_CHARS characters."""
    group, size = [], 0
    for value in column:
        text = value.as_py() or ""
        group.append(text)
        size += len(text)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", id_col: str = "doc_id", ids: bool = True) -> DataFrame:
    """One row per input row: the id column, ``n_tokens``, ``ids`` (if asked) and the two digests of a round trip.

    ``ids_sha256`` is over the ids as little-endian 32-bit integers, ``decoded_sha256`` over the bytes got by decoding
    them. Null and empty texts have no ids and the digest of nothing. Repeated rows give repeated results. Other
    columns, whatever their names, are not read. ``ranks_path`` must exist on the executors, as an installed package.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = codec(ranks_path, pattern)
        for batch in batches:
            at = 0
            for texts in _groups(batch.column(1)):
                counts, lists, digests, back = [], [], [], []
                for packed in own.encode(texts):
                    out = np.frombuffer(packed, "<u4")
                    counts.append(len(out))
                    lists.append(out.astype(np.int32) if ids else None)
                    digests.append(hashlib.sha256(packed).hexdigest())
                    back.append(hashlib.sha256(own.decode(out)).hexdigest())
                columns = [batch.column(0).slice(at, len(texts)), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return docs.select(id_col, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The bytes behind ``ids``: the id column and ``bytes`` (binary). Null ids decode to no bytes."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        own = codec(ranks_path, pattern)
        for batch in batches:
            raw = [own.decode(np.asarray(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=[id_col, "bytes"])

    return encoded.select(id_col, "ids").mapInArrow(run, f"{id_col} {kind}, bytes binary")

"""Toxicity by multiple-instance learning: a sentence model trained from document labels through a noisy-or.

A document is toxic unless all of its sentences are clean: P = 1 - prod(1 - p(sentence)). Only documents have labels;
the gradient of the noisy-or tells the sentences apart, so the model can point at the offending ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorpool.llm.common import _LOWER, bound_batches, mix, slices, span_hasher, stream, utf8, word_spans

#: Labelled documents the model is fitted on, at most; those with the smallest hash of their id are taken.
FIT_ROWS = 8_000
#: Hashed features: each word, and its first bytes, so that the forms of one stem share evidence.
STEMS = (4, 5, 6)
BUCKETS = 1 << 18
#: A feature is used if it stands in so many of the fitted documents.
MIN_DOCS = 8
#: Bytes of text the model is fitted on, at most, one document at least; in the same order as the rows.
FIT_BYTES = 64 << 20
#: Features of the sample that one step of the fit handles at once on the driver.
FIT_BLOCK = 1 << 20
#: Bytes of text looked at together, one text at least: the arrays over single bytes stay small.
SLICE = 1 << 18
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True  # line feed ! . ?
_MARK = _END.copy()
_MARK[[34, 39, 40, 41, 44, 45, 58, 59]] = True  # " ' ( ) , - : ;
_SALT = stream(29, 1 + len(STEMS))


def sentence_words(data: np.ndarray, edges: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences of whole texts and their word features.

    A sentence ends at . ! ? or a line feed, and at the end of the text. Words are what stands between white space
    and the usual marks, in lower case. Returns per word its bucket and sentence number, and per sentence its row and
    its byte place (start, end) in the row. Sentences without a word are left out.
    """
    base = edges[0]
    text, local = data[base : edges[-1]], edges - base
    closes = _END[text]
    number = np.cumsum(closes, dtype=np.int32) - closes  # of the sentence each byte belongs to
    row = np.repeat(np.arange(len(edges) - 1, dtype=np.int32), np.diff(edges))
    clean = np.where(_MARK[text], np.uint8(32), _LOWER[text])
    from_, to = word_spans(clean, local)
    if not len(from_):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    key = number[from_] + row[from_]  # rows split sentences too: the sum rises at every border of either kind
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    sentence = np.cumsum(fresh) - 1
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(from_)) - 1
    where = row[from_[heads]]
    start = from_[heads] - local[where]
    stops = np.flatnonzero(_END[text])
    after = np.searchsorted(stops, from_[tails])
    end = np.where(after < len(stops), stops[np.minimum(after, max(len(stops) - 1, 0))] + 1 if len(stops) else 0, len(text))
    end = np.minimum(end, local[where + 1]) - local[where]
    hashes = span_hasher(clean)
    kinds, owners = [mix(hashes(from_, to) ^ _SALT[0])], [sentence]
    for k, size in enumerate(STEMS, 1):
        longer = to - from_ >= size
        kinds.append(mix(hashes(from_[longer], from_[longer] + size) ^ _SALT[k]))
        owners.append(sentence[longer])
    bucket = (np.concatenate(kinds) % np.uint64(buckets)).astype(np.int64)
    pair = np.unique(np.concatenate(owners) * np.int64(buckets) + bucket)  # presence, not count
    return pair % buckets, pair // buckets, where, start, end


@dataclass(frozen=True)
class Model:
    """Weights by bucket and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def sentences(self, bucket: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(sentence, self.weights[bucket], n)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def noisy_or(logits: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """1 - prod(1 - p) of each row; a row without sentences gets 0."""
    return -np.expm1(-np.bincount(row, _softplus(logits), n))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", rows: int = FIT_ROWS, steps: int = 150) -> Model:
    """Fit on a bounded sample of the labelled ids (the ``rows`` smallest hashes), by Adam on the driver.

    An id with several labels has the greater. Null ids, labels and texts are not used. With one class only, or none,
    the model scores everything the same: close to that class, or 0.5 without any row. The sample of ids has at most
    ``rows`` rows and ``FIT_BYTES`` of text and is broadcast to the scan of the texts, which are not shuffled.
    """
    one = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_i")).agg(F.max(label).cast("int").alias("_y"))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("_i"), F.col(text).alias("_t"))
    chosen = one.orderBy(F.xxhash64("_i"), "_i").limit(rows)
    sizes = texts.select("_i", F.octet_length("_t").alias("_n")).join(F.broadcast(chosen), "_i").groupBy("_i").agg(F.max("_n").cast("long").alias("_n"), F.max("_y").alias("_y"))
    upto = F.sum("_n").over(Window.orderBy(F.xxhash64("_i"), "_i"))  # over ``rows`` rows at most
    chosen = sizes.withColumn("_upto", upto).where((F.col("_upto") <= FIT_BYTES) | (F.col("_upto") == F.col("_n"))).select("_i", "_y")
    # rows that repeat an id are one document: the greatest text counts
    sample = texts.join(F.broadcast(chosen), "_i").groupBy("_i").agg(F.max("_t").alias("_t"), F.max("_y").alias("_y"))
    bound_batches(docs.sparkSession)

    def features(batches):
        for batch in batches:
            data, edges = utf8(batch.column(1))
            for first, last in slices(edges, SLICE):
                bucket, sentence, where, _, _ = sentence_words(data, edges[first : last + 1])
                of = where[sentence] if len(where) else where
                cuts = np.searchsorted(of, np.arange(last - first + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array([bucket[i:j].astype("<i4").tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                        pa.array([sentence[i:j].astype("<i4").tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                    ],
                    names=["i", "y", "bucket", "sentence"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    table = sample.select("_i", "_t", "_y").mapInArrow(features, f"i {kind}, y int, bucket binary, sentence binary").toArrow()
    order = pc.sort_indices(table.column("i")).to_numpy()  # the rows stay where they are: a sorted copy is as large
    y = table.column("y").to_numpy()[order].astype(np.float64)
    if not len(y) or len(np.unique(y)) < 2:
        return Model(np.zeros(BUCKETS), 0.0 if not len(y) else (4.0 if y[0] else -12.0))
    # features seen in few documents teach nothing about others; they go before the rows are put together
    seen = np.zeros(BUCKETS, np.int64)
    for x in table.column("bucket"):
        seen[np.unique(np.frombuffer(x.as_buffer(), "<i4"))] += 1
    used = seen >= min(MIN_DOCS, max(2, len(y) // 50))
    slot = (np.cumsum(used) - 1).astype(np.int32)
    f_parts, s_parts, row_parts, n = [], [], [], 0
    for r, k in enumerate(order):
        x, z = (np.frombuffer(table.column(c)[int(k)].as_buffer(), "<i4") for c in ("bucket", "sentence"))
        if len(x):
            names, place = np.unique(z, return_inverse=True)
            keep = used[x]
            f_parts.append(slot[x[keep]])
            s_parts.append((place[keep] + n).astype(np.int32))
            row_parts.append(np.full(len(names), r, np.int32))
            n += len(names)
    if not n:
        return Model(np.zeros(BUCKETS), 0.0)
    del table, x, z
    f = np.concatenate(f_parts)
    del f_parts
    s, row = np.concatenate(s_parts), np.concatenate(row_parts)
    del s_parts
    m = int(used.sum())
    blocks = [slice(a, a + FIT_BLOCK) for a in range(0, len(f), FIT_BLOCK)]
    w, b = np.zeros(m), -6.0
    moment, square = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        z, pull = np.full(n, b), 2.0 * w
        for own in blocks:  # sentences come in order, so a block touches few of them
            low, high = s[own][0], s[own][-1] + 1
            z[low:high] += np.bincount(s[own] - low, w[f[own]], high - low)
        none = np.bincount(row, _softplus(z), len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        odds = np.where(y > 0, -1 / np.maximum(np.expm1(np.minimum(none, 50)), 1e-9), 1.0)  # d loss / d none
        g = odds[row] * p
        for own in blocks:
            pull += np.bincount(f[own], g[s[own]], m)
        grad = np.append(pull, g.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        move = 0.15 * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w -= move[:m]
        b -= move[m]
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(weights, float(b))


def _scored(batch: pa.RecordBatch, column: int, model: Model):
    """Per slice of the batch: its first row, scores, and the sentences' row, start, end and logit."""
    data, edges = utf8(batch.column(column))
    empty = -np.expm1(-_softplus(np.array(model.bias)))
    for first, last in slices(edges, SLICE):
        bucket, sentence, where, start, end = sentence_words(data, edges[first : last + 1])
        n = last - first
        logits = model.sentences(bucket, sentence, len(where))
        has = np.bincount(where, minlength=n) > 0
        yield first, np.where(has, noisy_or(logits, where, n), empty), where, start, end, logits


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id", limit: float = 0.5) -> DataFrame:
    """Every row of ``docs``: the id, ``score`` (0 to 1) and ``spans``: the sentences with p >= ``limit``.

    A span has the byte places ``start`` and ``end`` in the UTF-8 text and ``p``. Null and empty texts and texts
    without words have no sentence; they score as one sentence without features. Whole texts are read.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            for first, scores, where, start, end, logits in _scored(batch, 1, own):
                n = len(scores)
                p = 1 / (1 + np.exp(-logits))
                hot = np.flatnonzero(p >= limit)
                offsets = np.searchsorted(where[hot], np.arange(n + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(start[hot]), pa.array(end[hot]), pa.array(p[hot])], names=["start", "end", "p"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(scores), pa.ListArray.from_arrays(pa.array(offsets), spans)], names=[id_col, "score", "spans"]
                )

    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, score double, spans array<struct<start:bigint,end:bigint,p:double>>")


def accept(docs: DataFrame, model: Model, below: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``below``."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    column = docs.columns.index(text)

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            scores = [s for _, s, *_ in _scored(batch, column, own)]
            yield batch.filter(pa.array(np.concatenate(scores) < below if scores else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels of the training fold: crc32 of the id as text, modulo 4, is not 2."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)

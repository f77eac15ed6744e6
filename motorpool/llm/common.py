"""Helpers shared by the text operators: table access, lineage cuts and whole-buffer text hashing in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from motorpool.session import scratch_path

SLICE_BYTES = 1 << 21
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Parquet's row groups are checked at every hundredth row and hold 128 MB otherwise, and a reader opens one as a whole.
LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(1 << 23)}


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared scratch folder and read back: later plans start at files that outlive any executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``written``, whose shuffle files go when the write has ended: all that is read later is in the table."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return written(df, label, **options)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def bound_batches(spark: SparkSession, size: str = "16m") -> None:
    """Limit Arrow batches by bytes, so that many long texts in a row cannot fill a worker; a limit already set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "-1", str(2**31 - 1), str(2**63 - 1)):
        spark.conf.set(key, size)


def return_memory() -> None:
    """Let this worker give the memory of freed arrays back to the system, where its C library has that choice, those of
    Arrow too: workers live as long as the executor, and what they hold counts beside its heap."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 1 << 19)  # M_MMAP_THRESHOLD: larger blocks are mapped on their own and unmapped when freed
        pa.set_memory_pool(pa.system_memory_pool())


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of a splittable generator; a bijection, so distinct inputs stay distinct."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit constants."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _GAMMA)


_BYTE_CODE = stream(7, 256)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and n+1 offsets; null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    _, offsets, data = array.buffers()
    edges = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), edges


def slices(edges: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, one row at least; temporary arrays then stay small."""
    first, n = 0, len(edges) - 1
    while first < n:
        last = int(np.searchsorted(edges, edges[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(text: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are not ASCII white space; runs end at the rows' edges ``local``."""
    solid = ~_SPACE[text]
    cut = np.zeros(len(text) + 1, bool)
    cut[local] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hasher(text: np.ndarray):
    """A function that hashes many byte ranges of ``text`` at once: a polynomial over random byte codes taken from
    prefix sums, so a slice costs a few array passes whatever the lengths of its words."""
    up, down = _powers(len(text) + 1)
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[text] * up[: len(text)], out=total[1:])
    return lambda start, stop: mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def word_hashes(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (run without ASCII white space, A-Z lower-cased) and each row's place in that list (n+1).

    ``edges`` may begin anywhere in ``data``.
    """
    text, local = _LOWER[data[edges[0] : edges[-1]]], edges - edges[0]
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(len(edges), np.int64)
    start, stop = word_spans(text, local)
    return span_hasher(text)(start, stop), np.searchsorted(start, local)


def grouped(batches, key: int = 0) -> Iterator[pa.Table]:
    """Tables that hold whole groups of ``key`` from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(values, values[-1], side="left"))
        if last > 0:
            held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)

"""What the text operators hold in memory at once does not grow with the table."""

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from motorpool.llm import lmscore


def test_lm_chunks_lie_in_small_row_groups(spark, monkeypatch):
    frames, plain = {}, lmscore._written

    def keep(df, label):
        frames[label] = plain(df, label)
        return frames[label]

    monkeypatch.setattr(lmscore, "_written", keep)
    letters = np.random.default_rng(1).integers(97, 123, (60, 500_000), np.uint8)
    docs = spark.createDataFrame([(i, bytes(x).decode()) for i, x in enumerate(letters)], "doc_id long, text string").coalesce(1)
    lmscore.score(docs, docs.where("doc_id < 20").select("doc_id"))
    held = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in frames["packed"].inputFiles()]
    sizes = [m.row_group(k).total_byte_size for m in held for k in range(m.num_row_groups)]
    assert sum(sizes) > 3e7 and max(sizes) <= 1.4e7  # two chunks at most


def test_losses_by_blocks_of_words_are_those_of_the_whole_chunk(spark, monkeypatch):
    texts = [(i, None if i % 7 == 0 else " ".join(f"w{(i * k) % 23}" for k in range(i % 19))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    good = docs.where(F.col("doc_id") % 3 == 0).select("doc_id")
    whole = lmscore.score(docs, good).orderBy("doc_id").collect()
    monkeypatch.setattr(lmscore, "_TOKENS", 5)
    assert lmscore.score(docs, good).orderBy("doc_id").collect() == whole

"""A corpus pipeline over ``documents``: toxicity, repeated passages, near copies, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet into the shared
scratch folder and reads it again, so a lost executor costs one stage at most. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorpool.llm import bpe, chunks, leaks, nearcopies, toxicity
from motorpool.llm.common import table, written

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC_FROM``; the model is fitted on the labelled ones among ``docs``."""
    model = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.accept(docs, model, TOXIC_FROM)


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages. A document of which only blank lines are left goes; one that was blank stays. Rows
    without an id and null texts stay as they are; rows that repeat an id are one document."""
    out = chunks.drop_repeated(docs)
    return out.where("n_removed = 0 or text rlike '[^ \\\\t\\\\r\\\\n]'").select(*docs.columns).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the smallest id. Rows without an id stay."""
    gone = nearcopies.near_copies(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_chunks),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaked),
    ("byte_bpe", encode),
]

#: A fitted model and a tokenizer stand in the chain, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

"""From raw documents to token ids: quality, near copies, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Rows with null or empty text pass the first four stages as
far as their operators let them (no words: kept) and end with no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkaudit.llm import bpe, decontamination, neardup, pii, quality
from sparkaudit.session import cut_lineage


#: Most bytes of an Arrow batch. A batch is held several times, in workers and in the JVM outside its heap.
BATCH_BYTES = 1_000_000


def _small_batches(spark: SparkSession) -> None:
    """Every stage sets this for the session: what it returns runs later, so the setting can't go back with it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are more likely of the lowest grade than above it."""
    _small_batches(spark)
    return quality.select(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, 0.8)."""
    _small_batches(spark)
    return neardup.drop_duplicates(docs, width=5)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents with ten consecutive words of a benchmark item."""
    _small_batches(spark)
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the text."""
    _small_batches(spark)
    return pii.mask_pii(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids (32-bit little-endian) and their number, checked by decoding them again."""
    _small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = cut_lineage(bpe.encode_texts(docs, path))  # so that a task needs one Python worker, not two
    decoded = bpe.decode_ids(encoded, path)
    same = decoded["decoded"].eqNullSafe(decoded["text"]) | decoded["text"].isNull()
    return decoded.withColumn("round_trip", same).drop("decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("pii", no_personal_data),
    ("bpe", tokens),
]

#: Fitted models and token ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs

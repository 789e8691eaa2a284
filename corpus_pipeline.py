"""From raw documents to packed training sequences.

``STAGES`` are applied in turn; each takes (spark, docs, sf_dir) and returns a table,
which is written as Parquet and read again as the next one's ``docs``. All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwell.llm import mixing, packing, pii, quality, queries, simhash
from tripwell.sources.storage import store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for trusted text of their language."""
    return quality.keep_good(docs, queries.trusted(spark, sf_dir))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.deduplicate(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048; a document taken twice is packed twice."""
    return packing.pack(docs, queries.vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL cannot state a fitted model, a hash of shingles, or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

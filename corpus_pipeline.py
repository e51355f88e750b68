"""The corpus pipeline: language ID, exact and near deduplication, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafmill.llm import decontaminate, exact_dedup, lang_id, minhash
from sheafmill.llm.common import documents, frozen
from sheafmill.llm.queries import bpe_digests


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language that was learned, go."""
    return lang_id.keep_identified(docs, lang_id.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) one stays."""
    return minhash.deduplicate(docs, width=5, threshold=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, documents(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: A trained classifier and a tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = frozen(stage(spark, docs, sf_dir), name)
    return docs

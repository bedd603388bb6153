"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  A stage's output is
a table in the shared folder, so a lost executor costs at most one stage's tasks.
All stages share the executors: Python batches are bounded in bytes for the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emporia.llm import bpe, decontaminate, exact_dedup, minhash, quality
from emporia.llm.common import bound_batches, read, written
from emporia.llm.queries import tokenizer_path
from emporia.session import configure


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    bound_batches(spark)
    return quality.accepted(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of equal texts."""
    return exact_dedup.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    return minhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    bound_batches(spark)
    return bpe.digest_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: The classifier, the near-dedup classes and the tokens are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and gives a
DataFrame; all but the last give the columns of ``documents``. ``run`` writes what a stage
gives to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.llm.decontaminate import without_benchmark
from deskmill.llm.near_dedup import distinct_documents
from deskmill.llm.packing import pack, tokenizer_path
from deskmill.llm.pii import redacted
from deskmill.llm.quality import of_quality
from deskmill.session import materialized, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's perplexity band go."""
    return of_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of near copies: five-word shingles, similarity 0.8."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are masked; ``n_chars`` follows the text."""
    masked = redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, a row for each piece of a document."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can express neither the models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return docs

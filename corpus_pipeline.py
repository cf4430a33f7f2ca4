"""A training corpus from raw documents: five stages, each a table that the next one reads.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``, whatever they are called. Ids, texts, languages and sources are the columns
``doc_id``, ``text``, ``lang`` and ``source``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import mixing, near_dup, packing, quality_rules, secrets
from lakeferry.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays."""
    return near_dup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text where it was known."""
    clean = docs.withColumn("text", secrets.redacted(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        known = F.col("n_chars").isNotNull() & F.col("text").isNotNull()
        clean = clean.withColumn("n_chars", F.when(known, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents as often as the mix takes them, in training order."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mix),
    ("packing", pack),
]

# Tokenizers and regular expression positions are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"{place}-{name}")
        if place:
            scratch.drop(f"{place - 1}-{STAGES[place - 1][0]}")
    return docs

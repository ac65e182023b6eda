"""Corpus pipeline: documents -> quality -> line dedup -> near-dedup -> decontamination -> pieces.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's docs; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm import decontaminate, line_dedup, near_dup, pieces, quality
from cinerank.session import materialize
from cinerank.sources.testdata import load_tables


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps: neither junk nor toxic."""
    model = quality.train(docs, load_tables(spark, sf_dir, "labels")["labels"])
    return quality.keep_good(docs, model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines cut from all but their first document; n_chars follows the text.

    A document that loses all its lines to earlier ones goes.
    """
    cut = line_dedup.dedup_lines(docs).filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                          .cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return near_dup.remove_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    return decontaminate.remove_contaminated(docs, load_tables(spark, sf_dir, "benchmark")["benchmark"])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the piece ids of their whole text."""
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: The classifier and the pieces are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = load_tables(spark, sf_dir, "documents")["documents"]
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs

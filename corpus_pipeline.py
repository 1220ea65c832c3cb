"""Corpus cleaning as a chain of stages, each written as Parquet and read again by the next.

For every stage: an empty table gives an empty result; whole texts are read, however long; rows that repeat are treated alike
unless a stage says otherwise; null ids are kept or dropped by their own text. The input's columns travel apart from what a stage computes, so
further columns whose names clash with those of an operator stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import compression, decontaminate, line_dedup, mixing, ngram_join
from tidemark.llm.base import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict as good go; a score at the threshold stays.

    Null and empty texts score alike and stay or go together.
    """
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.score(docs, model).where("predicted = 1").select("_row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except from the document with the smallest id; n_chars follows the text, no row goes.

    A null text stays null. Rows that share an id count as one document, null ids as one after all others.
    """
    out = line_dedup.dedup_lines(docs).select("_row.*", F.col("kept").alias("_kept"))
    text = F.when(F.col("text").isNotNull(), F.col("_kept"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("text").isNotNull(), F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays, the one with the smallest id, null ids last.

    Of rows with that id the one whose text is smallest stays, of rows alike in both one. Null, empty and blank texts all stay.
    """
    return ngram_join.keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; null and empty texts hold none."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target and taken words.

    Rows alike in id, source and text are taken together. Texts without words have nothing to take and go. A null source is one of its own.
    Input columns with the names of the added ones are replaced.
    """
    return mixing.taken_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]

#: Classifier and sampling cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), f"pipeline-{name}")

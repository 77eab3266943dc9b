"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Stages work on all rows that the stage before kept. All but the last return the columns of ``documents``; a stage that drops
documents drops whole rows, the redaction replaces text and brings n_chars in line with it. The filtering stages take their documents
as the table of Parquet files that they are, so rows are numbered and dropped without a copy of the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.llm import decontamination, near_dup, personal_data, quality_model, tree_bpe
from tradeloom.llm.queries import tokenizer_path
from tradeloom.llm.shared import lean, table
from tradeloom.session import written_alone


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_model.of_good_quality(docs, table(lean(spark), sf_dir, "labels"))


def deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    lean(spark)
    return near_dup.without_near_duplicates(docs, stored=True)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.without_leaks(docs, table(lean(spark), sf_dir, "benchmark"), stored=True)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by tags."""
    lean(spark)
    redacted = docs.withColumn("text", personal_data.redacted_text(F.col("text")))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return redacted


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    lean(spark)
    return tree_bpe.digest(docs, tokenizer_path())


STAGES = [("quality classifier", quality), ("near duplicates", deduplication), ("benchmark decontamination", leaks),
          ("personal data", privacy), ("token ids", tokens)]
ORACLE_SQL = None  # the classifier and the encoder can't be written in SQL; tests hold the run against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # what a stage wrote on its way goes when its result is written
        docs = written_alone(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

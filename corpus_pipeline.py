"""Corpus pipeline: quality, exact duplicates, near duplicates, benchmark passages, mixture.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is written and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``; null and empty texts go through like any
others. Every row goes or stays by its own text under a row key of its own, whatever its id.

The near stage keeps the ball hashing of the SimHash operator and not its fingerprints: those of two texts at
similarity 0.8 differ in about ten of 64 bits, too many to meet. It hashes balls around several sketches of one-bit
minima instead and compares the shingles of every pair that meets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.common import in_fold, kept_rows, table, with_row_key
from shardloom.llm.decontaminate import decontaminated
from shardloom.llm.exact_dedup import exact_duplicates
from shardloom.llm.pareto_mix import pareto_mix
from shardloom.llm.quality import THRESHOLD, fit_quality, quality_scores
from shardloom.llm.shingle_dedup import similar_rows
from shardloom.session import as_written, without_leftovers


@without_leftovers
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    model = fit_quality(docs, table(spark, sf_dir, "labels").filter(~in_fold(F.col("doc_id"), 0)))
    rows = with_row_key(docs)
    scored = quality_scores(rows, model, "__row").select(F.col("doc_id").alias("__row"), (F.col("score") >= THRESHOLD).alias("keep"))
    return kept_rows(rows, scored, "__row").drop("__row")


@without_leftovers
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id, a null id only where there is no other; of rows of one id, one."""
    rows = with_row_key(docs)
    found = exact_duplicates(rows.withColumn("__id", F.struct("doc_id", "__row")), "__id")
    return kept_rows(rows, found.select("doc_id.__row", F.col("kept").alias("keep")), "__row").drop("__row")


@without_leftovers
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with at least four fifths of their five-word shingles in common, the row with the smallest id."""
    rows = with_row_key(docs)
    return kept_rows(rows, similar_rows(rows).withColumnRenamed("row", "__row"), "__row").drop("__row")


@without_leftovers
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the limits of contamination, without the benchmark passages that are left in them."""
    return decontaminated(with_row_key(docs), table(spark, sf_dir, "benchmark"), "__row", size_col="n_chars").drop("__row")


@without_leftovers
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words and copies of every document the mixture takes."""
    return pareto_mix(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", decontaminate), ("mixing sources to target weights", mix)]

#: Compression by a trained dictionary and fingerprints of XXH64 have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = as_written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

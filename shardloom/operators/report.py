"""Corpus reports: estimates, totals, shares, manifest drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.prefix import exclusive_folds
from shardloom.operators.split import first_documents
from shardloom.spec import TOKENS_PER_CHAR

TOTAL = "__total__"


def source_estimate(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """Count, mean length, estimated tokens and first text of each source's leading documents, and a total.

    ``limits`` gives ``max_samples`` per source.
    """
    lead = first_documents(docs, limits).select(
        "mix_source", "ord", F.length("text").cast("long").alias("chars"), F.left(F.col("text"), F.lit(100)).alias("head")
    )
    per_source = lead.groupBy("mix_source").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("chars").alias("n_chars"),
        F.min_by("head", "ord").alias("first_text"),
    ).withColumn("est_tokens", F.floor(F.col("n_chars") * TOKENS_PER_CHAR).cast("long"))
    grouped = per_source.groupingSets([["mix_source"], []], "mix_source").agg(
        F.sum("n_samples").alias("n_samples"), F.sum("n_chars").alias("n_chars"),
        F.sum("est_tokens").alias("est_tokens"),
        F.when(F.grouping("mix_source") == 0, F.max("first_text")).alias("first_text"),
    )
    return grouped.select(
        F.coalesce("mix_source", F.lit(TOTAL)).alias("mix_source"), "n_samples",
        F.round(F.col("n_chars") / F.col("n_samples"), 6).alias("avg_chars"), "est_tokens", "first_text",
    )


def fertility(docs: DataFrame) -> DataFrame:
    """Measured tokens per character beside the rule-of-thumb estimate."""
    chars = F.sum(F.length("text").cast("long"))
    return docs.groupBy("mix_source").agg(
        F.count(F.lit(1)).alias("n_docs"), chars.alias("n_chars"), F.sum("n_tokens").alias("n_tokens"),
        F.floor(chars * TOKENS_PER_CHAR).cast("long").alias("est_tokens"),
    ).withColumn("tokens_per_char", F.round(F.try_divide("n_tokens", "n_chars"), 6))


def split_totals(docs: DataFrame) -> DataFrame:
    return docs.groupBy("mix_source", "split").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )


def mixture_report(budget_table: DataFrame, totals: DataFrame, tokens_per_step: int, max_tokens: int) -> DataFrame:
    """Target share against achieved share of train tokens, exhausted sources, and epochs of a planned run.

    ``totals`` comes from ``split_totals``; sources without rows report zero.
    """
    got = totals.groupBy("mix_source").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(F.col("split") == "train", F.col("n_tokens")).otherwise(0)).alias("train_tokens"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = budget_table.join(got, "mix_source", "left").select(
        "mix_source", "share", "budget", zero("n_docs"), zero("n_tokens"), zero("train_tokens")
    )
    all_train = F.sum("train_tokens").over(Window.partitionBy(F.lit(1)))  # one row per configured source
    achieved = F.coalesce(F.try_divide("train_tokens", all_train), F.lit(0.0))
    steps = F.floor(F.lit(max_tokens) / tokens_per_step)
    return rows.select(
        "mix_source", F.round(F.col("share") * 100, 4).alias("target_pct"),
        F.round(achieved * 100, 4).alias("achieved_pct"),
        F.round((achieved - F.col("share")) * 100, 4).alias("delta_pct"),
        "budget", "n_docs", "n_tokens", "train_tokens",
        (F.col("n_tokens") < F.col("budget")).alias("exhausted"),
        F.round(F.try_divide(steps * tokens_per_step, all_train), 6).alias("run_epochs"),
    )


def progress(docs: DataFrame, every: int, budget_table: DataFrame | None = None, tokens_per_second: float | None = None) -> DataFrame:
    """Running totals at every ``every``-th document of a source; with budgets, also what remains.

    With a measured rate, such as that of ``token_rate``, also the seconds since the source's start and to its budget.
    """
    ones = docs.withColumn("__one", F.lit(1).cast("long"))
    run = exclusive_folds(ones, {"__before": "__one", "__tok": "n_tokens"}, ["mix_source"], "ord")
    marks = run.select(
        "mix_source", (F.col("__before") + 1).alias("n_samples"),
        (F.col("__tok") + F.col("n_tokens")).alias("n_tokens"),
    ).filter(F.col("n_samples") % every == 0)
    if budget_table is None:
        return marks
    left = F.greatest(F.col("budget") - F.col("n_tokens"), F.lit(0))
    rows = marks.join(F.broadcast(budget_table.select("mix_source", "budget")), "mix_source").select(
        "mix_source", "n_samples", "n_tokens", left.alias("remaining")
    )
    if tokens_per_second is None:
        return rows
    elapsed = F.col("n_tokens") / float(tokens_per_second)
    return rows.withColumns({"rate": F.lit(float(tokens_per_second)), "elapsed_seconds": elapsed,
                             "eta_seconds": eta_seconds(F.col("remaining"), F.col("n_tokens"), elapsed)})


def token_rate(batches: DataFrame) -> DataFrame:
    """Tokens per second per source from ``(mix_source, n_tokens, seconds)`` rows of finished batches; null without time."""
    return batches.groupBy("mix_source").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("seconds").alias("seconds")).select(
        "mix_source", "n_tokens", "seconds", F.try_divide("n_tokens", "seconds").alias("rate"))


def eta_seconds(remaining: Column, tokens: Column, elapsed: Column) -> Column:
    """Seconds left at the rate so far; null before the first token."""
    return F.try_divide(remaining, F.try_divide(tokens, elapsed))


def manifest_drift(listed: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Compare manifest entries with files: ``(name, listed_tokens, disk_tokens, status)``."""
    a = listed.select("name", F.col("num_tokens").alias("listed_tokens"))
    b = on_disk.select("name", F.col("num_tokens").alias("disk_tokens"))
    status = (
        F.when(F.col("disk_tokens").isNull(), "missing_on_disk")
        .when(F.col("listed_tokens").isNull(), "not_in_manifest")
        .when(F.col("listed_tokens") != F.col("disk_tokens"), "size_mismatch")
        .otherwise("both")
    )
    return a.join(b, "name", "full_outer").withColumn("status", status)

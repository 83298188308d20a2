"""Token budgets and the train/validation split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.prefix import take_first, take_until


def unit_draw(*parts: Column | str) -> Column:
    """A reproducible number in [0, 2**32) from the parts; the same under any partitioning."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def with_split(docs: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Add ``split``. Each document draws from its own key, so adding a source moves no other document."""
    limit = math.ceil(fraction * 2**32)
    draw = unit_draw(str(seed), F.col("mix_source"), F.col("ord"))
    return docs.withColumn("split", F.when(draw < limit, "val").otherwise("train"))


def budgets(mixture: DataFrame, max_tokens: int | None) -> DataFrame:
    """Normalised weight and token budget per source; the total runs over the configured sources only."""
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy(F.lit(1)))
    budget = F.lit(None).cast("long") if max_tokens is None else F.floor(F.lit(float(max_tokens)) * share)
    return mixture.select(
        "mix_source", "source_ord", "weight", share.alias("share"), budget.cast("long").alias("budget")
    )


def budget_cut(docs: DataFrame, budget_table: DataFrame, bits: int = 16) -> DataFrame:
    """Documents of each source, in key order, until its budget is reached; the crossing one is kept."""
    return take_until(docs, "n_tokens", "mix_source", "ord", budget_table, "budget", bits)


def first_documents(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """The first ``max_samples`` documents of each source in key order; sources with 0 are skipped."""
    return take_first(docs, docs, "mix_source", "ord", limits, "max_samples")

"""Running aggregates over an ordered key without one task per group.

A plain ``Window.partitionBy(source)`` puts a whole source into one task. Here rows are grouped into fixed
blocks of 2**bits consecutive keys; block totals run over the (small) block table, itself blocked once
more, and the row-level window only spans one block. The blocks depend on the key alone, so a re-run task
gives the same result. Keys are integers, unique per group, and dense enough to stay below 2**48.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.session import as_written, cut_lineage

BLOCK_BITS = 16


@dataclass(frozen=True)
class Fold:
    """An associative aggregate together with the way to combine two of its results."""

    agg: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]


SUM = Fold(F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
MIN = Fold(F.min, lambda a, b: F.least(a, b))
MAX = Fold(F.max, lambda a, b: F.greatest(a, b))


def _before(parts: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def block_offsets(df: DataFrame, values: Sequence[str], parts: Sequence[str], order: str, fold: Fold = SUM,
                  bits: int = BLOCK_BITS) -> DataFrame:
    """One row per (parts, ``__b``): per value ``__total_*`` of the block and ``__off_*`` of all earlier ones.

    The block table is written, being tiny beside the rows and used twice: the rows are read once for it.
    """
    parts = list(parts)
    blocks = cut_lineage(
        df.groupBy(*parts, F.shiftright(F.col(order), bits).alias("__b"))
        .agg(*[fold.agg(F.col(v)).alias(f"__total_{v}") for v in values])
        .withColumn("__bb", F.shiftright("__b", bits))
    )
    upper = (
        blocks.groupBy(*parts, "__bb").agg(*[fold.agg(F.col(f"__total_{v}")).alias(f"__u_{v}") for v in values])
        .select(*parts, "__bb", *[fold.agg(F.col(f"__u_{v}")).over(_before(parts, "__bb")).alias(f"__uoff_{v}")
                                  for v in values])
    )
    inner = blocks.withColumns({
        f"__in_{v}": fold.agg(F.col(f"__total_{v}")).over(_before([*parts, "__bb"], "__b")) for v in values})
    return inner.join(upper, [*parts, "__bb"]).select(
        *parts, "__b", *[f"__total_{v}" for v in values],
        *[fold.join(F.col(f"__uoff_{v}"), F.col(f"__in_{v}")).alias(f"__off_{v}") for v in values],
    )


def exclusive_folds(df: DataFrame, outs: dict[str, str], parts: Sequence[str], order: str,
                    fold: Fold = SUM, bits: int = BLOCK_BITS) -> DataFrame:
    """Add, per output name, the fold of its value over all earlier rows of the group.

    Other columns ride along in the same exchange; the offset join uses the window's partitioning.
    """
    parts, values = list(parts), list(dict.fromkeys(outs.values()))
    offsets = block_offsets(df, values, parts, order, fold, bits)
    w = _before([*parts, "__b"], order)
    local = df.withColumn("__b", F.shiftright(F.col(order), bits)).withColumns(
        {f"__local_{v}": fold.agg(F.col(v)).over(w) for v in values})
    return local.join(offsets, [*parts, "__b"]).select(
        *df.columns, *[fold.join(F.col(f"__off_{v}"), F.col(f"__local_{v}")).alias(o) for o, v in outs.items()])


def exclusive_fold(df: DataFrame, value: str, parts: Sequence[str], order: str, out: str,
                   fold: Fold = SUM, bits: int = BLOCK_BITS) -> DataFrame:
    """Add ``out``: the fold of ``value`` over all earlier rows of the group (null or 0 for the first)."""
    return exclusive_folds(df, {out: value}, parts, order, fold, bits)


def row_position(df: DataFrame, parts: Sequence[str], order: str, out: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Add ``out``: the 0-based position of the row in its group."""
    ones = df.withColumn("__one", F.lit(1).cast("long"))
    return exclusive_fold(ones, "__one", parts, order, out, SUM, bits).drop("__one")


def cut_points(df: DataFrame, value: str, part: str, order: str, limits: DataFrame, limit: str,
               bits: int = BLOCK_BITS) -> DataFrame:
    """Last key per group that is kept when rows are taken until the running total reaches the limit.

    ``limits`` has one row per configured group. Only the block in which a group crosses its limit is read
    row by row; groups that never cross give no row.
    """
    crossing = (
        block_offsets(df, [value], [part], order, SUM, bits)
        .select(part, "__b", F.col(f"__off_{value}").alias("__off"), F.col(f"__total_{value}").alias("__total"))
        .join(F.broadcast(limits.select(part, limit)), part)
        .filter((F.col("__off") < F.col(limit)) & (F.col("__off") + F.col("__total") >= F.col(limit)))
        .select(part, "__b", "__off", limit)
    )
    rows = df.select(part, order, value, F.shiftright(F.col(order), bits).alias("__b"))
    running = F.coalesce(F.sum(value).over(_before([part, "__b"], order)), F.lit(0)) + F.col("__off")
    return (
        rows.join(F.broadcast(crossing), [part, "__b"])
        .withColumn("__excl", running)
        .filter(F.col("__excl") < F.col(limit))
        .groupBy(part)
        .agg(F.max(order).alias("cut_ord"))
    )


def take_until(df: DataFrame, value: str, part: str, order: str, limits: DataFrame, limit: str,
               bits: int = BLOCK_BITS) -> DataFrame:
    """Keep rows in key order until the running total of ``value`` reaches the group's limit.

    The row that crosses the limit is kept. A null limit keeps everything, a limit of 0 nothing. The rows
    themselves are filtered in place against one cut key per group and never shuffled.
    """
    cuts = cut_points(df, value, part, order, limits, limit, bits)
    bounds = limits.select(part, F.col(limit).alias("__limit")).join(cuts, part, "left")
    keep = F.col("__limit").isNull() | (
        (F.col("__limit") > 0) & (F.col("cut_ord").isNull() | (F.col(order) <= F.col("cut_ord")))
    )
    return df.join(F.broadcast(bounds), part).filter(keep).select(*df.columns)


def take_first(df: DataFrame, narrow: DataFrame, part: str, order: str, limits: DataFrame, limit: str,
               bits: int = BLOCK_BITS) -> DataFrame:
    """The first ``limit`` rows of each group in key order, read behind a bound on the key.

    ``narrow`` has the group and key of every row of ``df``, without its wide columns; it is written once and
    counted there. The last key wanted of each group becomes a constant of the plan - one per configured group - so
    that the scan of ``df`` skips what lies behind it, and the wide columns are read once.
    """
    ones = as_written(narrow.select(part, order).withColumn("__one", F.lit(1).cast("long")), "keys")
    cuts = {r[part]: r["cut_ord"] for r in cut_points(ones, "__one", part, order, limits, limit, bits).collect()}
    wanted = F.lit(False)
    for row in limits.select(part, limit).collect():
        here = F.col(part) == row[part]
        if row[limit] is not None and row[limit] <= 0:
            continue
        wanted = wanted | (here & (F.col(order) <= cuts[row[part]]) if row[part] in cuts and row[limit] is not None else here)
    return df.filter(wanted)


def trailing_mean(df: DataFrame, value: str, parts: Sequence[str], order: str, size: int, out: str,
                  span: int = 1 << BLOCK_BITS) -> DataFrame:
    """Mean of ``value`` over the last ``size`` rows of the group, fewer at its start.

    Rows are bucketed by position; the last rows of a bucket are also sent to the next one, so that every
    window is complete inside its bucket.
    """
    parts = list(parts)
    span = max(span, size)
    at = row_position(df, parts, order, "__rn")
    bucket = F.expr(f"__rn div {span}")
    tail = F.expr(f"__rn % {span}") >= span - (size - 1)
    spread = at.withColumn("__k", F.explode(F.when(tail, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))))
    w = Window.partitionBy(*parts, "__k").orderBy("__rn").rowsBetween(-(size - 1), 0)
    return (
        spread.withColumn(out, F.avg(value).over(w))
        .filter(F.col("__k") == bucket)
        .select(*df.columns, out)
    )

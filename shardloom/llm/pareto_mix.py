"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size gives every document floor(r) certain copies. The rest of the target
is a fixed-size sample with unequal odds: a document's odds of inclusion fall with the length of its text, so that
repeated words are spread over many documents and not over a few long ones. The odds of a source have one common
factor, at which the expected words are those wanted. Documents are ranked by their random odds divided by these odds
and taken in that order; the last place goes to the document, among those not taken, whose size is nearest to what is
then missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import with_few
from shardloom.session import as_written

WEIGHTS = (5, 2, 1)
FACTOR = 1.5
MOST_COPIES = 2
SEED = 42
#: A source's ranks are summed over so many ranges first, so that only one range of it is ordered row by row.
RANGES = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights=WEIGHTS, factor: float = FACTOR, most: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from one row per source.

    Sources in code point order, null last, take the weights in turn and share ``factor`` times all sizes; a
    target stops at ``most`` times its source's size, and the excess is shared again by weight. Sources are
    ordered by the level at which they fill up; the first that does not sets the level of all after it.
    """
    if not 0 <= factor <= most:
        raise ValueError("the targets cannot exceed the most copies of everything")
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sizes.withColumn("w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn - 1) % len(weights) + 1))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    full = ranked.withColumn("cap", F.col("source_size") * most).select(
        "source", "source_size", "w", "cap", F.row_number().over(filling).alias("k"),
        (F.sum("source_size").over(everything) * F.lit(float(factor))).alias("all_words"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
    ).withColumn("level", (F.col("all_words") - F.col("cap_before")) / F.col("w_left"))
    stops = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("k"))
    at = full.withColumn("stop", F.min(stops).over(everything))
    level = F.max(F.when(F.col("k") == F.col("stop"), F.col("level"))).over(everything)
    return at.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("k") < F.col("stop"), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))).alias("target"))


def leaning(size: Column) -> Column:
    """Odds of a document relative to its source's others: one over the binary digits of its size."""
    return 1.0 / F.length(F.bin(size)).cast("double")


def pareto_rank(u: Column, lean: Column, factor: Column) -> Column:
    """Random odds over inclusion odds."""
    return (u / (1 - u)) / lean / factor


def with_factors(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with ``factor``: odds of ``factor * lean`` make the expected words of the sample those of ``rest``.

    Documents of as many binary digits have the same odds, so a source is a list of at most 64 classes, and the factor
    is found by halving between a sample of nothing and one of everything.
    """
    classes = rows.filter("size > 0").groupBy("source", leaning(F.col("size")).alias("lean")).agg(F.sum("size").cast("double").alias("words"))
    lists = as_written(classes.groupBy(F.col("source").alias("__s")).agg(F.collect_list(F.struct("lean", "words")).alias("classes")), "classes")
    expected = lambda f: F.aggregate("classes", F.lit(0.0), lambda s, c: s + c["words"] * (f * c["lean"]) / (1 + f * c["lean"]))
    middle = lambda s: (s["low"] + s["high"]) / 2
    halve = lambda s, _: F.when(expected(F.exp(middle(s))) < F.col("rest"), F.struct(middle(s).alias("low"), s["high"].alias("high"))).otherwise(
        F.struct(s["low"].alias("low"), middle(s).alias("high")))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(50)), F.struct(F.lit(-50.0).alias("low"), F.lit(50.0).alias("high")), halve, middle)
    return plan.join(lists, F.col("source").eqNullSafe(F.col("__s")), "left").withColumn("factor", F.exp(found)).drop("__s", "classes")


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights=WEIGHTS, factor: float = FACTOR, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken, copies``.

    ``size`` counts words (null and empty texts: 0), ``taken`` is ``copies`` times it; copies are whole and at
    most ``most``. A null source is a source of its own, the last. Rows that repeat an id are drawn together,
    ties being broken by size; a source without words takes nothing; other columns are not read; an empty table
    gives an empty result. The draw depends on ids and ``seed``, not on the layout. The text is read once.
    """
    rows = as_written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        uniform(F.col(id_col), seed).alias("u")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = as_written(source_targets(sizes, weights, factor, most).withColumn("whole", F.floor(ratio).cast("long"))
                      .withColumn("inclusion", ratio - F.col("whole"))
                      .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "shares")
    plan = as_written(with_factors(rows, plan), "targets")
    rank = pareto_rank(F.col("u"), leaning(F.col("size")), F.coalesce("factor", F.lit(1.0)))
    ranked = with_few(rows, plan, ["source"]).withColumn("rank", F.when(F.col("inclusion") > 0, rank))
    # Ranks lie about one; as r / (1 + r) they are spread over the unit interval, and its ranges are ranges of ranks.
    range_ = F.floor(F.col("rank") / (1 + F.col("rank")) * RANGES).cast("int")
    ranged = ranked.withColumn("range", range_)
    totals = ranged.groupBy("source", "rest", "range").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
    crossing = as_written(
        totals.withColumn("upto", upto).filter(F.col("upto") > F.col("rest"))
        .groupBy("source").agg(F.min_by(F.struct("range", (F.col("rest") - F.col("upto") + F.col("words")).alias("room")),
                                        "range").alias("c"))
        .select("source", F.col("c.range").alias("cut_range"), F.col("c.room").alias("room")), "crossing")
    place = F.struct("rank", "doc_id", "size")
    inside = with_few(ranged, crossing, ["source"]).filter(F.col("range") == F.col("cut_range"))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id", "size")
                             .rowsBetween(Window.unboundedPreceding, 0))
    cuts = (
        inside.withColumn("run", run).groupBy("source", "cut_range", "room")
        .agg(F.max(F.when(F.col("run") <= F.col("room"), place)).alias("last"),
             F.max(F.when(F.col("run") <= F.col("room"), F.col("run"))).alias("filled"))
        .withColumn("gap", F.col("room") - F.coalesce("filled", F.lit(0)))
    )
    cuts = as_written(cuts, "cuts")
    cut = with_few(ranged, cuts, ["source"])
    first = (F.col("range") < F.col("cut_range")) | (
        (F.col("range") == F.col("cut_range")) & F.coalesce(place <= F.col("last"), F.lit(False)))
    off = F.abs(F.col("size") - F.col("gap"))
    extra = as_written(
        cut.filter(~first & (F.col("size") > 0) & (off < F.col("gap")))
        .groupBy("source").agg(F.min(F.struct(off.alias("off"), "rank", "doc_id", "size")).alias("x"))
        .select("source", F.struct("x.rank", "x.doc_id", "x.size").alias("fill")), "last-places")
    ends = cuts.select("source", "cut_range", "last").join(
        extra.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
    plan = plan.join(ends.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
    drawn = with_few(rows, plan, ["source"]).withColumn("rank", F.when(F.col("inclusion") > 0, rank)).withColumn("range", range_)
    fits = F.col("cut_range").isNull() & (F.col("rest") > 0)
    sampled = F.when(fits | first | F.coalesce(place == F.col("fill"), F.lit(False)), F.lit(1)).otherwise(0)
    copies = F.col("whole") + F.when(F.col("inclusion") > 0, sampled).otherwise(0)
    return drawn.select("doc_id", "source", "size", "source_size", "target",
                        (copies * F.col("size")).cast("long").alias("taken"), copies.cast("long").alias("copies"))

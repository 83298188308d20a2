"""Laying documents out in shards, and numbering the shards.

Token positions inside a (source, split) identify documents: a document starts at the number of tokens
before it. Documents are never cut.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.prefix import exclusive_fold, row_position
from shardloom.session import as_written, cut_lineage
from shardloom.spec import BYTES_PER_TOKEN, SHARD_NAME, SHARD_PATTERN

GROUP = ["mix_source", "split"]


def with_start(docs: DataFrame, bits: int = 16) -> DataFrame:
    """Add ``start_tok``, the tokens before the document in its source and split."""
    return exclusive_fold(docs, "n_tokens", GROUP, "ord", "start_tok", bits=bits)


def shards_by_offset(docs: DataFrame, size: int, bits: int = 16) -> DataFrame:
    """Parallel fill: ``shard`` is the start position divided by the shard size.

    Every shard is within one document of the target size. Boundaries differ from ``shards_greedy``.
    """
    return with_start(docs, bits).withColumn("shard", F.expr(f"start_tok div {size}"))


# ---------------------------------------------------------------------------------------------------------
# Exact sequential fill.
#
# A shard that opens at position p closes with the first document whose end is at least p + size, and the
# next shard opens at that end. Positions are cut into segments of several shard sizes; a segment also sees
# the first ``size`` tokens' documents of the next one, so every shard that opens in it closes in view. One
# pass computes, per segment, where the chain of shards leaves it for every position at which a shard could
# enter it. Maps of neighbouring segments are composed level by level, the true entry is handed back down,
# and a last pass numbers the documents of the shards opened in each segment. No task sees more than one
# segment or one set of neighbouring maps.

SEGMENT_SHARDS = 16
FAN_IN = 32

_MAP = "mix_source string, split string, node long, entry long, exit long, n_shards long"
_ENTRY = "mix_source string, split string, node long, entry long, first_shard long"
_KEYS = [*GROUP, "node"]


def _next_open(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Per document: where the shard opened with it ends, or -1 if it stays open to the end of the data."""
    at = np.searchsorted(ends, starts + size, side="left")
    return np.where(at < len(ends), ends[np.minimum(at, len(ends) - 1)], -1)


def _follow(entries: np.ndarray, opens: np.ndarray, leaves: np.ndarray, steps: np.ndarray, limit: int):
    """Walk all entries at once from ``opens`` to ``leaves`` until they pass ``limit`` or run out."""
    here, count = entries.copy(), np.zeros(len(entries), dtype=np.int64)
    live = np.arange(len(entries))
    while len(live):
        at = np.minimum(np.searchsorted(opens, here[live]), len(opens) - 1)
        found = opens[at] == here[live]
        live, at = live[found], at[found]
        count[live] += steps[at]
        here[live] = leaves[at]
        live = live[(here[live] >= 0) & (here[live] < limit)]
    return here, count


def _segment_map(size: int, width: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start_tok")
        starts = pdf["start_tok"].to_numpy()
        ends = starts + pdf["n_tokens"].to_numpy()
        low, high = int(key[2]) * width, (int(key[2]) + 1) * width
        previous = np.concatenate([[low - 1], starts[:-1]])
        entries = starts[(starts >= low) & (starts < high) & (previous < low + size)]
        leaves = _next_open(starts, ends, size)
        exits, count = _follow(entries, starts, leaves, np.ones(len(starts), dtype=np.int64), high)
        return pd.DataFrame({"mix_source": key[0], "split": key[1], "node": key[2],
                             "entry": entries, "exit": exits, "n_shards": count})
    return run


def _compose(width: int):
    """One map out of those of neighbouring nodes. It can be entered at any entry of its first child, or,
    where one long document covers whole children, at the first document of a later child."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("entry")
        first_in_child = ~pdf["child"].duplicated()
        entries = pdf.loc[(pdf["child"] == pdf["child"].min()) | first_in_child, "entry"].to_numpy()
        exits, count = _follow(entries, pdf["entry"].to_numpy(), pdf["exit"].to_numpy(),
                               pdf["n_shards"].to_numpy(), (int(key[2]) + 1) * width)
        return pd.DataFrame({"mix_source": key[0], "split": key[1], "node": key[2],
                             "entry": entries, "exit": exits, "n_shards": count})
    return run


def _child_entries(key: tuple, maps: pd.DataFrame, here: int, shard: int, limit: float) -> pd.DataFrame:
    table = maps.set_index("entry")[["node", "exit", "n_shards"]]
    rows = []
    while 0 <= here < limit and here in table.index:
        node, leave, n = (int(v) for v in table.loc[here])
        rows.append((key[0], key[1], node, here, shard))
        here, shard = leave, shard + n
    return pd.DataFrame(rows, columns=["mix_source", "split", "node", "entry", "first_shard"])


def _root_entries(key: tuple, maps: pd.DataFrame) -> pd.DataFrame:
    return _child_entries(key, maps, 0, 0, float("inf"))


def _push_down(width: int):
    """The true entry of each child of a node, from the true entry of the node."""
    def run(key: tuple, maps: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(entry) or not len(maps):
            return _child_entries(key, maps, -1, 0, 0)
        return _child_entries(key, maps, int(entry["entry"].iloc[0]), int(entry["first_shard"].iloc[0]),
                              (int(key[2]) + 1) * width)
    return run


def _number_documents(size: int, width: int):
    def run(key: tuple, docs: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("start_tok")
        starts = docs["start_tok"].to_numpy()
        leaves = _next_open(starts, starts + docs["n_tokens"].to_numpy(), size)
        opens, here, high = [], -1, (int(key[2]) + 1) * width
        if len(entry):
            here = int(entry["entry"].iloc[0])
        while 0 <= here < high:
            at = int(np.searchsorted(starts, here))
            if at >= len(starts) or starts[at] != here:
                break
            opens.append(here)
            here = int(leaves[at])
        if opens:
            mine = starts >= opens[0]
            if here >= 0:
                mine &= starts < here
            base = int(entry["first_shard"].iloc[0]) - 1
            number = base + np.searchsorted(np.array(opens), starts[mine], side="right")
        else:
            mine, number = np.zeros(len(starts), dtype=bool), np.zeros(0, dtype=np.int64)
        return pd.DataFrame({"mix_source": key[0], "split": key[1],
                             "ord": docs["ord"].to_numpy()[mine], "shard": number})
    return run


def shards_greedy(docs: DataFrame, size: int, bits: int = 16, segment_shards: int = SEGMENT_SHARDS,
                  fan_in: int = FAN_IN) -> DataFrame:
    """Exact fill: append whole documents, close the shard once it holds ``size`` tokens, start anew.

    Adds ``start_tok`` and ``shard``, counted from 0 per source and split. The maps, one row per possible
    entry, are written as they are made, and composed until every source and split has a single one.
    """
    width = size * segment_shards
    placed = as_written(with_start(docs, bits), "starts")
    segment = F.expr(f"start_tok div {width}")
    in_head = (F.expr(f"start_tok % {width}") < size) & (segment > 0)
    viewed = as_written(placed.select(
        *GROUP, "ord", "n_tokens", "start_tok",
        F.explode(F.when(in_head, F.array(segment, segment - 1)).otherwise(F.array(segment))).alias("node"),
    ), "segments")
    maps, widths = [cut_lineage(viewed.groupBy(*_KEYS).applyInPandas(_segment_map(size, width), _MAP))], [width]
    while (maps[-1].agg(F.max("node")).first()[0] or 0) > 0:
        lifted = maps[-1].withColumnRenamed("node", "child").withColumn("node", F.expr(f"child div {fan_in}"))
        widths.append(widths[-1] * fan_in)
        maps.append(cut_lineage(lifted.groupBy(*_KEYS).applyInPandas(_compose(widths[-1]), _MAP)))

    entries = maps.pop().groupBy(*GROUP).applyInPandas(_root_entries, _ENTRY)
    while maps:
        below = maps.pop().withColumn("parent", F.expr(f"node div {fan_in}"))
        entries = (
            below.groupBy(*GROUP, "parent").cogroup(entries.groupBy(*_KEYS))
            .applyInPandas(_push_down(widths.pop()), _ENTRY)
        )
    numbers = (
        viewed.groupBy(*_KEYS).cogroup(entries.groupBy(*_KEYS))
        .applyInPandas(_number_documents(size, width), "mix_source string, split string, ord long, shard long")
    )
    return placed.join(numbers, [*GROUP, "ord"])


# ---------------------------------------------------------------------------------------------------------
# Shard tables


def shard_totals(docs: DataFrame) -> DataFrame:
    """Tokens, documents, key range and first token position of every shard."""
    return docs.groupBy("mix_source", "source_ord", "split", "shard").agg(
        F.sum("n_tokens").alias("num_tokens"), F.count(F.lit(1)).alias("n_docs"),
        F.min("ord").alias("min_ord"), F.max("ord").alias("max_ord"), F.min("start_tok").alias("shard_start"),
    )


def number_shards(totals: DataFrame, size: int, bits: int = 16) -> DataFrame:
    """Add ``shard_idx``: one counter for the run, shared by both splits, continuing over the sources.

    Shards are numbered by the key of the document that closed them; the unfilled last ones of a source
    follow, train first. A source without shards does not advance the counter. The shard table is written
    first, so that the pass over the documents runs once.
    """
    totals = cut_lineage(totals)
    last = totals.groupBy("mix_source", "split").agg(F.max("shard").alias("last_shard"))
    marked = totals.join(F.broadcast(last), GROUP).withColumn(
        "is_tail", (F.col("shard") == F.col("last_shard")) & (F.col("num_tokens") < size)
    )
    closed = row_position(marked.filter(~F.col("is_tail")), ["mix_source"], "max_ord", "pos", bits)
    per_source = marked.groupBy("mix_source", "source_ord").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_tail")).alias("n_closed"),
        F.count_if(F.col("is_tail") & (F.col("split") == "train")).alias("n_train_tail"),
    )
    before = Window.partitionBy(F.lit(0)).orderBy("source_ord").rowsBetween(Window.unboundedPreceding, -1)
    base = per_source.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("source_ord", "n")
    tail = marked.filter("is_tail").withColumn("pos", F.lit(None).cast("long"))
    tail_pos = F.col("n_closed") + F.when(F.col("split") == "val", F.col("n_train_tail")).otherwise(0)
    return (
        closed.unionByName(tail).join(F.broadcast(base), "mix_source")
        .withColumn("shard_idx", (F.col("base") + F.coalesce("pos", tail_pos)).cast("int"))
        .select(*totals.columns, "shard_idx")
    )


def with_ids(places: DataFrame, encoded: DataFrame) -> DataFrame:
    """Encoded documents with what was planned for them, joined by source and key.

    ``places`` is narrow; the one exchange of ids is the one of this join.
    """
    return encoded.join(places, ["mix_source", "ord"])


def shard_name(source: Column, split: Column, index: Column) -> Column:
    return F.format_string(SHARD_NAME, source, split, index)


def parse_shard_name(name: Column) -> Column:
    """``struct(source, split, shard_idx)`` of a shard file name, null for any other name."""
    part = lambda i: F.regexp_extract(name, SHARD_PATTERN, i)
    return F.when(
        name.rlike(SHARD_PATTERN),
        F.struct(part(1).alias("source"), part(2).alias("split"), part(3).cast("int").alias("shard_idx")),
    )


def size_report(totals: DataFrame, by: list[str]) -> DataFrame:
    """Bytes on disk of the shards, the space to plan for, and the space that leaves half again free."""
    size = F.sum("num_tokens") * BYTES_PER_TOKEN
    return totals.groupBy(*by).agg(
        F.sum("num_tokens").alias("n_tokens"), size.alias("n_bytes"),
        F.round(size * 1.2, 1).alias("bytes_needed"), F.round(size * 1.2 * 1.5, 1).alias("bytes_headroom"),
    )

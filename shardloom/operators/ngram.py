"""Held-out scoring with a smoothed bigram model, and candidate selection from its counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.operators.metrics import perplexity_capped
from shardloom.operators.split import unit_draw
from shardloom.session import cut_lineage

_SHIFT = 65536
#: Cells of a table of pair counts, and ids that are counted at once.
CELLS = 1 << 22
COUNTED = 1 << 20


def bigram_counts(docs: DataFrame, by: list[str]) -> DataFrame:
    """Counts of adjacent ids per group. The last id has no next and no pair.

    Pairs are counted where the documents lie, in a table of cells while one holds all pairs of the batch's ids and by
    sorting them otherwise; a pair travels as one number and once per batch.
    """
    kinds = dict(docs.dtypes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            lists = batch.column(len(by))
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            groups: dict[tuple, int] = {}
            rows = zip(*[batch.column(k).to_pylist() for k in range(len(by))]) if by else [()] * batch.num_rows
            group = np.array([groups.setdefault(r, len(groups)) for r in rows], np.int64)
            width = int(values[offsets[0]:offsets[-1]].max(initial=0)) + 1
            dense = len(groups) * width * width <= CELLS
            cells = np.zeros(len(groups) * width * width if dense else 0, np.int64)
            found, at = [], 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + COUNTED, side="right")) - 1)
                ids = values[offsets[at]:offsets[end]].astype(np.int64)
                sizes = np.diff(offsets[at:end + 1])
                paired = np.ones(len(ids), np.bool_)
                paired[np.cumsum(sizes)[sizes > 0] - 1] = False
                first = np.flatnonzero(paired)
                key = (np.repeat(group[at:end], sizes)[first] * width + ids[first]) * width + ids[first + 1]
                if dense:
                    cells += np.bincount(key, minlength=len(cells))
                else:
                    found.append(np.unique(key, return_counts=True))
                at = end
            if dense:
                found = [(there := np.flatnonzero(cells), cells[there])]
            for keys, n in found:
                which, pair = np.divmod(keys, width * width)
                named = list(groups)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([g[k] for g in named], batch.column(k).type).take(pa.array(which)) for k in range(len(by))],
                     pa.array(pair // width * _SHIFT + pair % width), pa.array(n)], names=[*by, "p", "n"])

    counted = docs.select(*by, "ids").mapInArrow(count, ", ".join([*[f"`{c}` {kinds[c]}" for c in by], "p long, n long"]))
    return counted.groupBy(*by, "p").agg(F.sum("n").alias("n")).select(
        *by, F.expr(f"cast(p div {_SHIFT} as int)").alias("prev"),
        F.expr(f"cast(p % {_SHIFT} as int)").alias("next"), "n",
    )


def bigram_perplexity(docs: DataFrame, vocab_size: int, alpha: float = 1.0) -> DataFrame:
    """Fit on train, score validation: weighted loss and perplexity per source.

    Both sides are counted before they meet, so the join sees distinct pairs, not tokens. The counts are
    written once and used for both.
    """
    counts = cut_lineage(bigram_counts(docs, ["mix_source", "split"]))
    fit = counts.filter("split = 'train'").groupBy("prev", "next").agg(F.sum("n").alias("c"))
    context = fit.groupBy("prev").agg(F.sum("c").alias("c_prev"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    loss = -F.log((zero("c") + alpha) / (zero("c_prev") + alpha * vocab_size))
    scored = (
        counts.filter("split = 'val'").join(fit, ["prev", "next"], "left").join(context, "prev", "left")
        .groupBy("mix_source").agg(F.sum("n").alias("n_tokens"), (F.sum(F.col("n") * loss) / F.sum("n")).alias("loss"))
    )
    return scored.select("mix_source", "n_tokens", "loss", perplexity_capped(F.col("loss")).alias("perplexity"))


def topk_nucleus(scores: DataFrame, top_k: int | None, top_p: float | None, temperature: float = 1.0) -> DataFrame:
    """Candidates kept per context of ``(context, token, score)``, with renormalised probability.

    Scores are divided by the temperature; all ties with the k-th stay; the nucleus is taken over the
    softmax of those left, and a candidate goes once the mass before it exceeds ``top_p``. The order of equal
    scores is by token. A context holds at most one row per vocabulary entry.
    """
    best = Window.partitionBy("context").orderBy(F.desc("s"))
    kept = scores.select("context", "token", (F.col("score") / temperature).alias("s"))
    if top_k is not None:
        kept = kept.withColumn("rk", F.rank().over(best)).filter(F.col("rk") <= top_k).drop("rk")
    whole = Window.partitionBy("context")
    kept = kept.withColumn("e", F.exp(F.col("s") - F.max("s").over(whole)))
    if top_p is not None:
        before = Window.partitionBy("context").orderBy(F.desc("s"), "token").rowsBetween(Window.unboundedPreceding, -1)
        mass = F.coalesce(F.sum("e").over(before), F.lit(0.0)) / F.sum("e").over(whole)
        kept = kept.withColumn("mass", mass).filter(F.col("mass") <= top_p).drop("mass")
    return kept.select("context", "token", (F.col("e") / F.sum("e").over(whole)).alias("prob"))


def sample_next(candidates: DataFrame, seed: int) -> DataFrame:
    """One weighted random token per context; the draw depends on seed, context and token only."""
    u = (unit_draw(str(seed), F.col("context"), F.col("token")) + 0.5) / float(2**32)
    noisy = F.log("prob") - F.log(-F.log(u))
    return candidates.withColumn("g", noisy).groupBy("context").agg(F.max_by("token", "g").alias("token"))

"""Exact shard fill as a stream: documents arrive in batches, closed shards appear as files, the open ones are carried.

What a batch leaves behind - the documents of every shard still open, the number of the next shard and the tokens each
source has used - is written under the batch's number and becomes the input of the next batch. A batch that is run
again reads the same state and replaces its own files and entries, so nothing is written twice and nothing is lost.
However the documents are cut into batches, the shards are those of ``operators.shards.shards_greedy``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.prefix import row_position
from shardloom.operators.shards import GROUP, shard_totals, shards_greedy
from shardloom.operators.split import budget_cut
from shardloom.session import as_written, discard
from shardloom.sources.shard_files import export_bin, manifest, write_manifest
from shardloom.stages import Stages

ROWS = "mix_source string, source_ord int, ord long, split string, n_tokens long, ids array<int>"
#: Per source: tokens used of its budget, and per split the shards closed.
COUNTERS = "mix_source string, source_ord int, split string, used long, closed long"
FINAL = "final"


@dataclass(frozen=True)
class ShardWriter:
    """Where shards, manifest and state go, and the settings of the fill.

    ``budgets`` has ``mix_source, budget`` (null: unlimited); without it all documents are taken.
    """

    spark: SparkSession
    out: str
    size: int
    tokenizer: str
    vocab_size: int
    budgets: DataFrame | None = None

    @property
    def _state(self) -> Stages:
        return Stages(self.spark, f"{self.out}/state")

    def _before(self, batch_id: int) -> tuple[DataFrame, DataFrame, int]:
        """What the batch before left: open documents, counters, and the next shard number."""
        if batch_id <= 0:
            return self.spark.createDataFrame([], ROWS), self.spark.createDataFrame([], COUNTERS), 0
        mark = self._state.mark_of(str(batch_id - 1))
        if mark is None:
            raise ValueError(f"{self.out}: batch {batch_id - 1} has left no state")
        path = self._state.path(str(batch_id - 1))
        read = lambda name, schema: self.spark.read.schema(schema).parquet(f"{path}/{name}")
        return read("open", ROWS), read("counters", COUNTERS), int(mark)

    def apply(self, batch: DataFrame, batch_id: int, last: bool = False) -> None:
        """Take in one batch of ``ROWS``; with ``last`` the open shards are closed as they are, those of train first."""
        carried, counters, next_idx = self._before(batch_id)
        new = as_written(batch.select(*[f.split()[0] for f in ROWS.split(", ")]), "batch")
        if self.budgets is not None:
            used = counters.groupBy("mix_source").agg(F.sum("used").alias("used"))
            left = self.budgets.select("mix_source", "budget").join(used, "mix_source", "left").select(
                "mix_source", F.greatest(F.col("budget") - F.coalesce("used", F.lit(0)), F.when(F.col("budget").isNotNull(), F.lit(0))).alias("budget"))
            thin = as_written(budget_cut(new.drop("ids"), left), "within-budget")
        else:
            thin = new.drop("ids")
        before = counters.select(*GROUP, F.col("closed").alias("first"))
        # The carried documents open a shard of their own, so the fill goes on as if it had not been cut.
        rows = as_written(carried.drop("ids").unionByName(thin.select("mix_source", "source_ord", "ord", "split", "n_tokens")), "rows")
        at = shards_greedy(rows, self.size).join(F.broadcast(before), GROUP, "left")
        at = as_written(at.withColumn("shard", F.col("shard") + F.coalesce("first", F.lit(0))).drop("first"), "places")
        shards = as_written(shard_totals(at).withColumn("whole", F.col("num_tokens") >= self.size), "shards")
        closing = shards if last else shards.filter("whole")
        # Sources in their order; whole shards by the document that closed them, then the rest, train before val.
        kind = F.when(F.col("whole"), 0).when(F.col("split") == "train", 1).otherwise(2)
        key = (F.col("source_ord") * 4 + kind).cast("long") * (1 << 48) + F.when(F.col("whole"), F.col("max_ord")).otherwise(0)
        one = row_position(closing.withColumn("__all", F.lit(0)).withColumn("__key", key), ["__all"], "__key", "__at")
        numbered = as_written(one.withColumn("shard_idx", (F.col("__at") + next_idx).cast("int")).drop("__all", "__key", "__at"), "numbered")
        ids = carried.unionByName(new).select("mix_source", "ord", "ids")
        placed = at.join(numbered.select(*GROUP, "shard", "shard_idx"), [*GROUP, "shard"]).select("mix_source", "split", "ord", "shard_idx")
        entries = as_written(export_bin(placed.join(ids, ["mix_source", "ord"]), f"{self.out}/shards"), "entries")
        write_manifest(manifest(entries, self.tokenizer, self.vocab_size, self.size, None), entries, f"{self.out}/manifest", part=batch_id)
        numbered.write.mode("overwrite").parquet(f"{self.out}/closed/part={batch_id}")
        open_ = at.join(shards.filter("not whole").select(*GROUP, "shard"), [*GROUP, "shard"], "left_semi")
        if last:
            open_ = open_.filter("false")

        def leave(path: str) -> None:
            open_.select("mix_source", "ord", "source_ord", "split", "n_tokens").join(ids, ["mix_source", "ord"]).write.parquet(f"{path}/open")
            done = numbered.groupBy("mix_source", "source_ord", "split").agg(F.lit(0).cast("long").alias("used"), F.count(F.lit(1)).alias("closed"))
            took = thin.groupBy("mix_source", "source_ord", "split").agg(F.sum("n_tokens").alias("used"), F.lit(0).cast("long").alias("closed"))
            counters.unionByName(done).unionByName(took).groupBy("mix_source", "source_ord", "split").agg(
                F.sum("used").alias("used"), F.sum("closed").alias("closed")).write.parquet(f"{path}/counters")

        self._state.run(str(batch_id), str(next_idx + numbered.count()), leave, anew=True)
        self._state.forget(str(batch_id - 2))
        for table in (new, rows, at, shards, numbered, entries, *([thin] if self.budgets is not None else [])):
            discard(table)

    def follow(self, documents: DataFrame, checkpoint: str) -> None:
        """Run the stream of ``ROWS`` to the end of what is there; documents of a source arrive in key order."""
        query = documents.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    def next_batch(self) -> int:
        """One above the last batch that left a state."""
        n = 0
        while self._state.mark_of(str(n)) is not None:
            n += 1
        return n

    def finish(self) -> None:
        """Close the shards that are still open."""
        self.apply(self.spark.createDataFrame([], ROWS), self.next_batch(), last=True)

    def closed(self) -> DataFrame:
        """All closed shards with their totals and numbers."""
        schema = ("mix_source string, source_ord int, split string, shard long, num_tokens long, n_docs long, min_ord long, max_ord long, "
                  "shard_start long, whole boolean, shard_idx int")
        return self.spark.read.schema(schema + ", part int").parquet(f"{self.out}/closed").drop("part")

"""From shards to training sequences and batches.

A worker reads its shards one after another as one token stream; sequences are equal cuts of that stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.encode import packed, unpacked
from shardloom.operators.prefix import BLOCK_BITS, exclusive_folds, row_position

LANE = ["split", "epoch", "rank", "worker"]
#: Shards whose places are sent to all tasks; of more, places and chunks are exchanged.
SENT_SHARDS = 1 << 20


def shard_list(numbered: DataFrame) -> DataFrame:
    """Add ``pos``, the place of the shard in its split's list (lists are ordered by shard index)."""
    return row_position(numbered, ["split"], "shard_idx", "pos")


def assign_workers(shards: DataFrame, num_workers: int, world_size: int = 1) -> DataFrame:
    """Add ``rank`` and ``worker``: shards go round the ranks, those of a rank round its workers.

    Every shard has exactly one reader; ranks do not read each other's data.
    """
    return shards.withColumn("rank", F.pmod("pos", F.lit(world_size)).cast("int")).withColumn(
        "worker", F.pmod(F.expr(f"pos div {world_size}"), F.lit(num_workers)).cast("int")
    )


def repeat_epochs(shards: DataFrame, epochs: int) -> DataFrame:
    """The shard list once per epoch."""
    return shards.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def reading_order(shards: DataFrame, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """Add ``read_pos`` and ``stream_off``, the tokens the worker has read before the shard.

    The shuffled order depends on seed + worker, on the epoch and on the shard's place in the list only. It
    sorts by 60 hash bits, whose top bits cut the list of a worker into even blocks.
    """
    if "epoch" not in shards.columns:
        shards = shards.withColumn("epoch", F.lit(0))
    if shuffle:
        digest = F.md5(F.concat_ws(":", (F.lit(seed) + F.col("worker")).cast("string"),
                                   F.col("epoch").cast("string"), F.col("pos").cast("string")))
        drawn, bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 44
    else:
        drawn, bits = F.col("pos"), BLOCK_BITS
    keyed = shards.withColumn("__draw", drawn).withColumn("__one", F.lit(1).cast("long"))
    placed = exclusive_folds(keyed, {"read_pos": "__one", "stream_off": "num_tokens"}, LANE, "__draw", bits=bits)
    return placed.drop("__draw", "__one").withColumn("read_pos", F.col("read_pos").cast("int"))


def stream_positions(places: DataFrame, ordered_shards: DataFrame) -> DataFrame:
    """``(mix_source, ord, n_tokens, at)`` and the lane: where each document starts in its reader's stream.

    ``places`` carries ``start_tok`` and ``shard`` without ids; ``ordered_shards`` comes from ``reading_order``
    with the shard's own ``shard_start``.
    """
    return places.select("mix_source", "split", "shard", "ord", "start_tok", "n_tokens").join(
        ordered_shards.select("mix_source", "shard", *LANE, "stream_off", "shard_start"),
        ["mix_source", "split", "shard"],
    ).select("mix_source", "ord", *LANE, (F.col("stream_off") + F.col("start_tok") - F.col("shard_start")).alias("at"))


def pack_sequences(docs: DataFrame, positions: DataFrame, seq_len: int) -> DataFrame:
    """Cut each worker's stream into sequences of ``seq_len`` tokens; the last remainder is dropped.

    ``docs`` carries ``mix_source, ord, n_tokens, ids`` and ``positions`` comes from ``stream_positions``. Documents
    meet their positions by key, are cut by ``slice``, never token by token, and the pieces are exchanged by sequence.
    """
    placed = docs.select("mix_source", "ord", "n_tokens", "ids").join(positions, ["mix_source", "ord"])
    first, last = F.expr(f"at div {seq_len}"), F.expr(f"(at + n_tokens - 1) div {seq_len}")
    cut = placed.withColumn("seq_idx", F.explode(F.sequence(first, last)))
    return _sequences(cut, seq_len)


def pack_chunks(chunks: DataFrame, ordered_shards: DataFrame, seq_len: int) -> DataFrame:
    """Sequences from the token chunks of shard files: ``source, split, shard_idx, start_tok, ids``.

    ``ordered_shards`` has the lane and ``stream_off`` of every ``source`` and ``shard_idx``. A sequence that lies in one
    chunk is cut out where the chunk is read; only pieces at the ends of chunks are exchanged, packed.
    """
    keys = ["source", "split", "shard_idx"]
    places = ordered_shards.select("source", "shard_idx", *LANE, "stream_off")
    if places.limit(SENT_SHARDS + 1).count() <= SENT_SHARDS:
        places = F.broadcast(places)
    placed = chunks.join(places, keys).select(
        *LANE, "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("stream_off") + F.col("start_tok")).alias("at"))
    # Sequences from the first that begins in the chunk to before the one that goes on behind it are whole.
    open_, close = F.expr(f"(at + {seq_len - 1}) div {seq_len}"), F.expr(f"(at + n_tokens) div {seq_len}")
    inner = placed.filter(open_ < close).withColumn("seq_idx", F.explode(F.sequence(open_, close - 1)))
    whole = inner.select(*LANE, "seq_idx", F.slice("ids", (F.col("seq_idx") * seq_len - F.col("at") + 1).cast("int"), seq_len).alias("input_ids"))
    first, last = F.expr(f"at div {seq_len}"), F.expr(f"(at + n_tokens - 1) div {seq_len}")
    ends = F.array_compact(F.array(F.when((first < open_) | (first >= close), first), F.when((last >= close) & (last > first), last)))
    place, piece = _piece(seq_len)
    cut = placed.withColumn("seq_idx", F.explode(ends)).select(*LANE, "seq_idx", place.alias("o"), piece.alias("ids"))
    joined = (
        cut.select(*LANE, "seq_idx", F.struct("o", F.size("ids").alias("n"), packed(F.col("ids")).alias("p")).alias("__piece"))
        .groupBy(*LANE, "seq_idx")
        .agg(F.sum("__piece.n").alias("__n"), F.array_sort(F.collect_list("__piece")).alias("__pieces"))
        .filter(F.col("__n") == seq_len)
        .select(*LANE, "seq_idx", unpacked(F.col("__pieces.p")).alias("input_ids"))
    )
    return whole.unionByName(joined)


def _piece(seq_len: int) -> tuple[Column, Column]:
    """Where in its sequence the part of a run of ids that lies in it begins, and that part."""
    low = F.col("seq_idx") * seq_len - F.col("at")
    begin = F.greatest(low, F.lit(0))
    end = F.least(low + seq_len, F.col("n_tokens"))
    return begin - low, F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int"))


def _sequences(cut: DataFrame, seq_len: int) -> DataFrame:
    """Full sequences from rows ``(lane, seq_idx, at, n_tokens, ids)``, one for each sequence a run of ids meets."""
    place, piece = _piece(seq_len)
    return (
        cut.select(*LANE, "seq_idx", F.struct(place.alias("o"), piece.alias("p")).alias("__piece"))
        .groupBy(*LANE, "seq_idx")
        .agg(F.array_sort(F.collect_list("__piece")).alias("__pieces"))
        .select(*LANE, "seq_idx", F.flatten(F.col("__pieces.p")).alias("input_ids"))
        .filter(F.size("input_ids") == seq_len)
    )


def sequences_per_worker(ordered_shards: DataFrame, seq_len: int) -> DataFrame:
    """Full sequences of every worker stream; one row per reader."""
    return ordered_shards.groupBy("split", "epoch", "rank", "worker").agg(
        F.expr(f"sum(num_tokens) div {seq_len}").alias("n_sequences")
    )


def with_batches(sequences: DataFrame, ordered_shards: DataFrame, seq_len: int, batch_size: int) -> DataFrame:
    """Add ``batch_id``: consecutive full batches per worker, an incomplete last one is dropped."""
    counts = sequences_per_worker(ordered_shards, seq_len)
    return (
        sequences.join(F.broadcast(counts), ["split", "epoch", "rank", "worker"])
        .withColumn("batch_id", F.expr(f"seq_idx div {batch_size}"))
        .filter((F.col("batch_id") + 1) * batch_size <= F.col("n_sequences"))
        .drop("n_sequences")
    )


def validation_cap(totals: DataFrame, seq_len: int, batch_size: int, most: int = 500) -> DataFrame:
    """One row: the number of validation batches to run, at least 1 and at most ``most``."""
    tokens = F.coalesce(F.sum(F.when(F.col("split") == "val", F.col("num_tokens"))), F.lit(0))
    return totals.agg(tokens.alias("val_tokens")).select(
        F.lit("val").alias("split"), "val_tokens",
        F.greatest(F.lit(1), F.least(F.floor(F.col("val_tokens") / (seq_len * batch_size)), F.lit(most)))
        .cast("long").alias("max_batches"),
    )


def next_token_labels(sequences: DataFrame) -> DataFrame:
    """Add ``labels``: position i is labelled with token i + 1, the last position with nothing."""
    size = F.size("input_ids")
    return sequences.withColumn(
        "labels", F.concat(F.slice("input_ids", F.lit(2), size - 1), F.array(F.lit(None).cast("int")))
    )


def sequence_counts(totals: DataFrame, seq_len: int, world_size: int) -> DataFrame:
    """Sequences of each split, and the length each rank reports."""
    return totals.groupBy("split").agg(F.sum("num_tokens").alias("n_tokens")).select(
        "split", "n_tokens", F.expr(f"n_tokens div {seq_len}").alias("n_sequences"),
        F.expr(f"n_tokens div {seq_len} div {world_size}").alias("n_per_rank"),
    )

"""Shards and manifests on disk: parquet tables, binary export, discovery, read back."""

from __future__ import annotations

import math
import operator
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.encode import packed, unpack
from shardloom.operators.shards import parse_shard_name, shard_name, with_ids
from shardloom.session import as_written, discard, file_uri, remove, sparing
from shardloom.sources.shard_source import READ_CHUNK, ShardFiles, store_of
from shardloom.spec import STALL_SECONDS, TOKENS_PER_SHARD
from shardloom.stages import Stages

# Fixed values of the format: names and words in manifests and status rows.
DTYPE = "uint16"
ACTIVE, STALLED = "ACTIVE", "MAYBE STALLED"
HEAD_SCHEMA = (
    "tokenizer string, vocab_size int, shard_size bigint, dtype string, total_train_tokens bigint, "
    "total_val_tokens bigint, val_fraction double"
)
ENTRY_SCHEMA = "split string, path string, num_tokens bigint, shard_idx int, source string"
ENTRY_COLUMNS = ("split", "path", "num_tokens", "shard_idx", "source")
ENTRY = "struct<path: string, num_tokens: bigint, shard_idx: int, source: string>"
MANIFEST_SCHEMA = f"{HEAD_SCHEMA}, train_shards array<{ENTRY}>, val_shards array<{ENTRY}>"
DOCUMENT_SHARDS = 1_000_000
EXPORTED = pa.schema([("path", pa.string()), ("num_tokens", pa.int64()), ("shard_idx", pa.int32()), ("source", pa.string()),
                      ("split", pa.string())])
EXPORT_SCHEMA = "path string, num_tokens long, shard_idx int, source string, split string"
PARTS_SCHEMA = "mix_source string, source_ord int, ord long, split string, n_tokens long, ids binary, part int"
#: Bytes of text that make a part of a corpus, and the parts of the largest corpus, a power of two.
PART_BYTES, MOST_PARTS = 1 << 26, 32
#: Documents of a turn whose places are sent to all tasks; of more, places and ids are exchanged by key.
SENT_PLACES = 1 << 19


class NoShardsError(ValueError):
    """The split has no shards, or the run produced no training tokens."""


# ------------------------------------------------------------------------------------------------ shard tables


SHARD_TABLE_KEYS = ["mix_source", "split"]


def write_shard_table(docs: DataFrame, path: str) -> None:
    """Write documents as parquet in one directory per source and split; a shard is a run of sorted rows in one file.

    A shard's rows go to the task of its hash, so that a directory has at most as many files as there are tasks,
    however many shards there are.
    """
    keys = [*SHARD_TABLE_KEYS, "shard_idx"]
    docs.repartition(*keys).sortWithinPartitions(*keys, "ord").write.partitionBy(*SHARD_TABLE_KEYS).parquet(path)


def read_shard_table(spark: SparkSession, path: str, columns: str, split: str | None = None) -> DataFrame:
    """The table with the columns given as DDL; names of sources stay text whatever they look like."""
    df = spark.read.schema(f"{columns}, mix_source string, split string").parquet(path)
    return df.filter(F.col("split") == split) if split else df


# ------------------------------------------------------------------------------------------------ binary form


def export_bin(docs: DataFrame, directory: str) -> DataFrame:
    """Write one little-endian 16-bit file per shard and return ``(path, num_tokens, shard_idx, source, split)``.

    ``ids`` are arrays, or ``packed`` already; packed ones are exchanged. A file appears under its final name only when complete, so a re-run task replaces it as a whole. Rows come to a
    task shard by shard; it holds one shard, bounded by the shard size, and a batch of rows. A path without a file
    system means Spark's default one.
    """
    directory = file_uri(docs.sparkSession, directory)
    keys = ["mix_source", "split", "shard_idx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(directory)
        shard, pieces = None, []

        def closed() -> list[tuple]:
            if shard is None:
                return []
            source, split, index, name = shard
            store.create_dir(base, recursive=True)
            partial = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(partial) as out:
                for piece in pieces:
                    out.write(piece.tobytes())
            store.move(partial, f"{base}/{name}")
            return [(name, sum(map(len, pieces)), index, source, split)]

        for batch in batches:
            done, held = [], batch.column(4)
            which = pa.StructArray.from_arrays([batch.column(k) for k in range(4)], names=[*keys, "name"])
            code = batch.column(3).dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else []
            for a, b in zip(starts, [*starts[1:], len(code)]):
                found = tuple(which[int(a)].as_py().values())
                if found != shard:
                    done += closed()
                    shard, pieces = found, []
                pieces += [unpack(data) for data in held.slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(EXPORTED.names, row)) for row in done], EXPORTED)
        yield pa.RecordBatch.from_pylist([dict(zip(EXPORTED.names, row)) for row in closed()], EXPORTED)

    name = shard_name(F.col("mix_source"), F.col("split"), F.col("shard_idx")).alias("name")
    if dict(docs.dtypes)["ids"] != "binary":
        docs = docs.select(*keys, "ord", packed(F.col("ids")).alias("ids"))
    rows = docs.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("ord")).select(*keys, name, "ids")
    return rows.mapInArrow(run, EXPORT_SCHEMA)


def part_bounds(docs: DataFrame, size: int = PART_BYTES, most: int = MOST_PARTS) -> dict[str, list[int]]:
    """Keys that cut every source into parts of about equally many documents; one row per source comes back.

    A power of two of them, so that the texts of a part have ``size`` bytes, and at most ``most`` parts.
    """
    cuts = F.percentile_approx("ord", [i / most for i in range(1, most)], 10_000) if most > 1 else F.array().cast("array<long>")
    rows = docs.groupBy("mix_source").agg(F.sum(F.octet_length("text")).alias("n"), cuts.alias("cuts")).collect()
    parts = min(most, 1 << math.ceil(math.log2(max(1.0, sum(r["n"] or 0 for r in rows) / size))))
    return {r["mix_source"]: (r["cuts"] or [])[most // parts - 1::most // parts][:parts - 1] for r in rows}


def write_parts(docs: DataFrame, bounds: dict[str, list[int]], path: str) -> None:
    """Encoded documents with their ids packed, in one folder per part of the keys."""
    part = F.lit(0)
    for source, cuts in bounds.items():
        above = [F.when(F.col("ord") > cut, 1).otherwise(0) for cut in cuts]
        part = F.when(F.col("mix_source") == source, reduce(operator.add, above, F.lit(0))).otherwise(part)
    rows = docs.select("mix_source", "source_ord", "ord", "split", "n_tokens", packed(F.col("ids")).alias("ids"), part.alias("part"))
    rows.write.option("compression", "zstd").partitionBy("part").parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS_SCHEMA).parquet(path)


def export_in_turns(encoded: str, at: DataFrame, shards: DataFrame, directory: str, turns: Stages, mark: str = "") -> DataFrame:
    """``export_bin`` of the parts of ``write_parts``, one after the other, and the entries of all shards.

    ``at`` has the shard and part of every document, ``shards`` the numbers of the shards. A shard is written in the turn of
    its last part. Of the parts before, only the keys that the turn's shards span are read again. Shuffle files go with
    their turn and a part with the last turn that reads it, so that the disk holds the shard files, and beside them a few
    parts of the ids. A turn is a stage: a run that was ended goes on after its last whole one. One row per turn, source
    and split comes to the driver.
    """
    spark, keys = at.sparkSession, ["mix_source", "split", "shard"]
    numbers = shards.select(*keys, "shard_idx").join(at.groupBy(*keys).agg(F.max("part").alias("turn")), keys)
    placed = as_written(at.join(numbers, keys).select("mix_source", "split", "ord", "part", "shard_idx", "turn"), "placed")
    spans = placed.groupBy("turn", "mix_source", "split").agg(
        F.min("part").alias("first"), F.min("ord").alias("low"), F.max("ord").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    order = sorted({s["turn"] for s in spans})
    for i, turn in enumerate(order):
        mine = [s for s in spans if s["turn"] == turn]

        def write(path: str) -> None:
            spanned = reduce(operator.or_, [(F.col("mix_source") == s["mix_source"]) & (F.col("split") == s["split"])
                                            & F.col("ord").between(s["low"], s["high"]) for s in mine])
            ids = read_parts(spark, encoded).filter(F.col("part").between(min(s["first"] for s in mine), turn) & spanned)
            places = placed.filter(F.col("turn") == turn).select("mix_source", "ord", "shard_idx")
            if sum(s["n"] for s in mine) <= SENT_PLACES:
                places = F.broadcast(places)
            export_bin(with_ids(places, ids.drop("part")), directory).write.parquet(path)

        with sparing(spark):
            turns.run(str(turn), f"{mark}-{turn}", write)
        needed = min((s["first"] for s in spans if s["turn"] in order[i + 1:]), default=0)
        for part in range(needed):
            remove(spark, f"{encoded}/part={part}")
    discard(placed)
    if not order:
        return spark.createDataFrame([], EXPORT_SCHEMA)
    return spark.read.schema(EXPORT_SCHEMA).parquet(*[turns.path(str(turn)) for turn in order])


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, name, length, modificationTime)``; the contents are not read."""
    files = spark.read.format("binaryFile").load(directory).select("path", "length", "modificationTime")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def discover_shards(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Shards by file name, and the rejected ones. Files with other names are ignored, empty ones never listed."""
    named = list_files(spark, directory).withColumn("s", parse_shard_name(F.col("name"))).filter("s is not null")
    rows = named.select(
        F.col("name").alias("path"), F.expr("length div 2").alias("num_tokens"), F.col("s.shard_idx").alias("shard_idx"),
        F.col("s.source").alias("source"), F.col("s.split").alias("split"), "length", "modificationTime",
    )
    whole = F.col("length") % 2 == 0
    bad = rows.filter(~whole).select("path", F.lit("odd number of bytes").alias("reason"))
    return rows.filter(whole & (F.col("length") > 0)).drop("length"), bad


def read_bin(spark: SparkSession, directory: str, chunk: int = READ_CHUNK, split: str | None = None) -> DataFrame:
    """Token chunks ``(source, split, shard_idx, start_tok, ids)`` of all shard files, or those of one split.

    Files are read in ranges of bounded size; those of another split are not opened. Where the session pushes filters
    to Python sources (``spark.sql.python.filterPushdown.enabled``), equalities on source, split and shard number
    choose the files as well.
    """
    spark.dataSource.register(ShardFiles)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("shard_files").option("chunk", str(chunk)).option("pushdown", pushed.lower())
    if split:
        reader = reader.option("split", split)
    return reader.load(file_uri(spark, directory))


# ------------------------------------------------------------------------------------------------ manifest


def _split_tokens(split: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("split") == split, F.col("num_tokens"))), F.lit(0)).cast("long")


def manifest(entries: DataFrame, tokenizer: str, vocab_size: int, shard_size: int | None, val_fraction: float | None) -> DataFrame:
    """The head of a manifest, one row: settings and token totals. The entries themselves are a table beside it.

    Settings given as null are measured when the manifest is read.
    """
    return entries.agg(
        _split_tokens("train").alias("total_train_tokens"), _split_tokens("val").alias("total_val_tokens"),
        F.coalesce(F.max(F.when(F.col("split") == "train", F.col("num_tokens"))), F.lit(0)).alias("largest"),
    ).select(
        F.lit(tokenizer).alias("tokenizer"), F.lit(vocab_size).alias("vocab_size"),
        (F.lit(shard_size).cast("long") if shard_size is not None else F.col("largest")).alias("shard_size"), F.lit(DTYPE).alias("dtype"),
        "total_train_tokens", "total_val_tokens", F.lit(val_fraction).cast("double").alias("val_fraction"),
    )


def _measured(heads: DataFrame) -> DataFrame:
    """One head out of those of several parts."""
    train, val = F.sum("total_train_tokens"), F.sum("total_val_tokens")
    share = F.coalesce(F.round(F.try_divide(val, train + val), 6), F.lit(0.0))
    return heads.agg(
        F.max("tokenizer").alias("tokenizer"), F.max("vocab_size").alias("vocab_size"), F.max("shard_size").alias("shard_size"),
        F.max("dtype").alias("dtype"), train.alias("total_train_tokens"), val.alias("total_val_tokens"),
        F.coalesce(F.max("val_fraction"), share).alias("val_fraction"))


def resync_manifest(entries: DataFrame, tokenizer: str, vocab_size: int) -> DataFrame:
    """The head rebuilt from files: shard size and validation share are measured."""
    return _measured(manifest(entries, tokenizer, vocab_size, None, None))


def write_manifest(head: DataFrame, entries: DataFrame, path: str, part: int = 0) -> None:
    """Write one part of a manifest: its entries, sorted by split and shard over all files, then its head.

    A part is complete once its head is there; writing it again replaces it.
    """
    entries.select(*ENTRY_COLUMNS).orderBy("split", "shard_idx").write.mode("overwrite").parquet(f"{path}/entries/part={part}")
    head.coalesce(1).write.mode("overwrite").json(f"{path}/head/part={part}")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(head, entries)`` of all complete parts of a manifest."""
    heads = spark.read.schema(HEAD_SCHEMA + ", part int").json(f"{path}/head")
    entries = spark.read.schema(ENTRY_SCHEMA + ", part int").parquet(f"{path}/entries")
    return _measured(heads), entries.join(heads.select("part"), "part", "left_semi").select(*ENTRY_COLUMNS)


def manifest_document(head: DataFrame, entries: DataFrame, most: int = DOCUMENT_SHARDS) -> DataFrame:
    """The manifest as the one document of the published format, both lists in shard order.

    For consumers that read that form: it holds every entry in one row, so their number is checked.
    """
    if entries.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} shards; use the entry table")
    entry = F.struct("shard_idx", "path", "num_tokens", "source")
    shape = lambda e: F.struct(e["path"].alias("path"), e["num_tokens"].alias("num_tokens"),
                               e["shard_idx"].alias("shard_idx"), e["source"].alias("source"))
    lists = entries.agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("split") == s, entry))), shape).alias(f"{s}_shards")
                          for s in ("train", "val")])
    return head.crossJoin(lists)  # one row each


def read_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def document_entries(row: DataFrame) -> DataFrame:
    """One row per shard listed in a manifest document."""
    def tagged(split: str) -> Column:
        return F.transform(f"{split}_shards", lambda e: F.struct(F.lit(split).alias("split"), e.alias("e")))

    both = F.concat(tagged("train"), tagged("val"))
    return row.select(F.explode(both).alias("x")).select("x.split", "x.e.*")


def resolved(entries: DataFrame, base: str) -> DataFrame:
    """Entries whose relative paths became base + file name; absolute ones stay."""
    absolute = F.col("path").rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:/)")
    file = F.element_at(F.split("path", "/"), -1)
    return entries.withColumn("path", F.when(absolute, F.col("path")).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), file)))


def select_split(entries: DataFrame, wanted: str = "val") -> DataFrame:
    """Entries of the wanted split, or of train where the wanted one has no shards."""
    any_wanted = entries.agg(F.count_if(F.col("split") == wanted).alias("n")).select(
        F.when(F.col("n") > 0, wanted).otherwise("train").alias("split")
    )
    return entries.join(F.broadcast(any_wanted), "split")


def require_shards(entries: DataFrame, split: str) -> DataFrame:
    """The entries unchanged; raises if the split has none, or none holds a token."""
    found = entries.filter(F.col("split") == split).agg(F.sum("num_tokens").alias("n")).first()["n"]
    if not found:
        raise NoShardsError(f"no shards with tokens in split '{split}'")
    return entries


def ingest_status(spark: SparkSession, directory: str, now: Column, tokens_per_shard: int = TOKENS_PER_SHARD) -> DataFrame:
    """One row: shard files, estimated tokens, newest file, its age in seconds, ACTIVE or MAYBE STALLED."""
    files = list_files(spark, directory).filter(F.col("name").endswith(".bin"))
    age = (now.cast("timestamp").cast("long") - F.col("last_time").cast("long")).alias("age_seconds")
    return files.agg(
        F.count(F.lit(1)).alias("n_files"), F.max_by("name", "modificationTime").alias("last_shard"),
        F.max("modificationTime").alias("last_time"),
    ).select("n_files", (F.col("n_files") * tokens_per_shard).alias("est_tokens"), "last_shard", age).withColumn(
        "state", F.when(F.col("age_seconds") < STALL_SECONDS, ACTIVE).otherwise(STALLED)
    )


def append_metrics(points: DataFrame, path: str) -> None:
    """Append ``(run_id, tag, step, value)`` points to a table partitioned by run."""
    points.write.mode("append").partitionBy("run_id").parquet(path)

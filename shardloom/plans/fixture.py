"""The driver tables as a corpus: sources, step records and parameters used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import shards as sh
from shardloom.operators.encode import count_bytes, encode_bytes, frame
from shardloom.operators.pack import assign_workers, reading_order, shard_list
from shardloom.operators.split import with_split
from shardloom.session import as_written, cut_lineage, scratch_path
from shardloom.sources import shard_files as sf
from shardloom.sources.readers import read_mixture, with_min_length
from shardloom.spec import MIN_CHARS_CORPUS, Mixture, SourceSpec

VAL_FRACTION = 0.05
SHARD_SIZE = 20_000
SEQ_LEN = 1024
MAX_TOKENS = 1_000_000
BATCH = 4
WORKERS = 4
RANKS = 2
SILENT_SECONDS = 43_200
SEED = 42
#: Merges of the query that trains, and of those that encode: as many as their SQL learns in reasonable time.
LEARNED, MERGES = 1024, 256


def mixture(sf_dir: str) -> Mixture:
    """The sources over the driver tables; ``spark.shardloom.scanPartitions``, where the session sets it, deals
    out files of a single row group."""
    session = SparkSession.getActiveSession()
    parts = session and session.conf.get("spark.shardloom.scanPartitions", None)
    parts = int(parts) if parts else None
    docs = f"{sf_dir}/documents.parquet"
    return Mixture(
        (
            SourceSpec("text", docs, key="doc_id", weight=60, scan_partitions=parts),
            SourceSpec("code", docs, key="doc_id", filter_lang="fr", weight=25, scan_partitions=parts),
            SourceSpec("chat", f"{sf_dir}/conversations.parquet", key="conv_id", field="messages",
                       turn_rows=True, weight=15, scan_partitions=parts),
        ),
        SHARD_SIZE, VAL_FRACTION, SEED,
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, min_chars: int = MIN_CHARS_CORPUS) -> DataFrame:
    """All documents that pass the length filter, with text."""
    return with_min_length(read_mixture(spark, mixture(sf_dir)), min_chars)


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with split and framed token count, without text."""
    docs = with_split(count_bytes(corpus(spark, sf_dir)), VAL_FRACTION, SEED)
    return docs.select("mix_source", "source_ord", "ord", "split", "n_tokens")


def counted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``counted`` as a written table: planning reads a few bytes per document and the text only once."""
    return as_written(counted(spark, sf_dir), "counted")


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with split and framed byte ids, without text."""
    docs = with_split(frame(encode_bytes(corpus(spark, sf_dir))), VAL_FRACTION, SEED)
    return docs.select("mix_source", "source_ord", "ord", "split", "n_tokens", "ids")


def encoded_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``encoded`` as a written table: shards are planned on its narrow columns, ids are read at the end."""
    return as_written(encoded(spark, sf_dir), "encoded")


def encoded_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """The folder of ``encoded`` as a written table in parts of the keys, with packed ids."""
    path = scratch_path(spark, "encoded")
    sf.write_parts(encoded(spark, sf_dir), sf.part_bounds(corpus(spark, sf_dir)), path)
    return path


def numbered(docs: DataFrame) -> DataFrame:
    """Shards of the parallel fill with their run-wide index."""
    thin = docs.select("mix_source", "source_ord", "ord", "split", "n_tokens")
    return sh.number_shards(sh.shard_totals(sh.shards_by_offset(thin, SHARD_SIZE)), SHARD_SIZE)


def entries(shards: DataFrame) -> DataFrame:
    """Manifest entries of numbered shards."""
    return shards.select(
        sh.shard_name(F.col("mix_source"), F.col("split"), F.col("shard_idx")).alias("path"),
        "num_tokens", "shard_idx", F.col("mix_source").alias("source"), "split",
    )


def lanes(shards: DataFrame) -> DataFrame:
    """Numbered shards with their reader and their place in its stream, written once as they are used twice."""
    return cut_lineage(reading_order(assign_workers(shard_list(shards), WORKERS, RANKS), SEED))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step records read from the event log: one run per event type, four ranks."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("run_id"), (F.col("user_id") % 4).cast("int").alias("rank"),
        F.col("event_id").alias("step"), (F.col("value") / 100).alias("step_time"),
        (F.col("value") * (F.col("event_id") % 10) / 1000).alias("data_wait"),
        (F.lit(1024) + (F.col("event_id") % 7) * 128).cast("long").alias("tokens"),
        (F.col("value") / 20).alias("loss"), (F.col("value") / 40).alias("grad_norm"),
        (F.lit(8) + (F.col("user_id") % 10) / 10).alias("gpu_mem"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as metric points with a zoned timestamp."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("tag"), F.col("event_id").alias("step"), "value",
                    F.col("ts").cast("timestamp").alias("ts"))

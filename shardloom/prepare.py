"""From a mixture to shards with a manifest, and from shard files to training sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import shards as sh
from shardloom.operators.encode import encode_in_place, frame
from shardloom.operators.pack import assign_workers, pack_chunks, reading_order, shard_list
from shardloom.operators.split import budget_cut, budgets, with_split
from shardloom.session import as_written, remove, sparing
from shardloom.sources import shard_files as sf
from shardloom.sources.readers import FAILURE_SCHEMA, read_mixture_isolated, with_min_length
from shardloom.spec import MIN_CHARS_CORPUS, Mixture
from shardloom.stages import Stages, chained, file_marks, fingerprint, table_mark

FILLS = {"exact": sh.shards_greedy, "offset": sh.shards_by_offset}


@dataclass(frozen=True)
class Prepared:
    """Where a run wrote, its manifest, the sources that failed, and the stages that an earlier run had finished."""

    path: str
    head: DataFrame
    entries: DataFrame
    failures: DataFrame
    skipped: tuple[str, ...] = ()


def shard_places(thin: DataFrame, size: int, fill: str = "exact") -> tuple[DataFrame, DataFrame]:
    """``(places, shards)``: the shard of every document, and the numbered shards, from narrow columns alone.

    ``fill`` is ``exact``, which closes a shard with the document that fills it, or ``offset``.
    """
    at = as_written(FILLS[fill](thin, size), "places")
    return at, sh.number_shards(sh.shard_totals(at), size)


DOCUMENTS = "mix_source string, source_ord int, ord long, text string"
STAGES = ("sources", "encoded", "thin", "places", "shards", "entries", "manifest")


def prepare(spark: SparkSession, mixture: Mixture, merges: DataFrame, vocab_size: int, out: str, tokenizer: str = "tokenizer",
            max_tokens: int | None = None, fill: str = "exact", min_chars: int = MIN_CHARS_CORPUS) -> Prepared:
    """Read, filter, encode, split, cut to budget, lay out in shards, write the shard files and the manifest.

    Files go to ``out/shards``, the manifest to ``out/manifest``. A source that fails leaves nothing behind and takes
    no shard number. The ids are exchanged once, by shard.

    Every stage is kept in ``out/work`` under a mark of the sources' files, the merges and the settings. A run that was
    ended goes on after its last whole stage, one with other inputs starts anew, and a finished one changes nothing.
    The work folder can be deleted at any time. Texts go once they are encoded, and ids as their shards are written.
    """
    with sparing(spark):
        return _prepare(spark, mixture, merges, vocab_size, out, tokenizer, max_tokens, fill, min_chars)


def _prepare(spark: SparkSession, mixture: Mixture, merges: DataFrame, vocab_size: int, out: str, tokenizer: str,
             max_tokens: int | None, fill: str, min_chars: int) -> Prepared:
    work = Stages(spark, f"{out}/work")
    mark = chained(fingerprint([file_marks(spark, s.location) for s in mixture.sources], mixture, table_mark(merges), vocab_size,
                               tokenizer, max_tokens, fill, min_chars), STAGES)

    def read(path: str) -> None:
        docs, failures = read_mixture_isolated(spark, mixture, folder=f"{path}/docs")
        if docs is None:
            raise ValueError("no source can be read")
        failures.write.parquet(f"{path}/failures")

    def encode(path: str) -> None:
        docs = spark.read.option("recursiveFileLookup", "true").schema(DOCUMENTS).parquet(f"{sources}/docs")
        kept = frame(encode_in_place(with_min_length(docs, min_chars), merges))
        sf.write_parts(with_split(kept, mixture.val_fraction, mixture.seed), sf.part_bounds(docs), path)

    def cut() -> DataFrame:
        thin = sf.read_parts(spark, encoded).drop("ids")
        return thin if max_tokens is None else budget_cut(thin, budgets(mixture.table(spark), max_tokens))

    def export(path: str) -> None:
        turns = Stages(spark, work.path("turns"))
        sf.export_in_turns(encoded, at, shards, f"{out}/shards", turns, mark["entries"]).write.parquet(path)

    def list_all(path: str) -> None:
        sf.require_shards(entries, "train")
        head = sf.manifest(entries, tokenizer, vocab_size, mixture.tokens_per_shard, mixture.val_fraction)
        sf.write_manifest(head, entries, f"{out}/manifest")

    gone = work.mark_of("encoded") != mark["encoded"] and not work.has("sources/docs")
    sources = work.run("sources", mark["sources"], read, anew=gone)
    encoded = work.run("encoded", mark["encoded"], encode)
    remove(spark, f"{sources}/docs")
    thin = work.table("thin", mark["thin"], cut)
    at = work.table("places", mark["places"], lambda: FILLS[fill](thin, mixture.tokens_per_shard))
    shards = work.table("shards", mark["shards"], lambda: sh.number_shards(sh.shard_totals(at), mixture.tokens_per_shard))
    entries = spark.read.parquet(work.run("entries", mark["entries"], export))
    work.forget("encoded")
    work.run("manifest", mark["manifest"], list_all)
    failures = spark.read.schema(FAILURE_SCHEMA).parquet(f"{sources}/failures")
    return Prepared(out, *sf.read_manifest(spark, f"{out}/manifest"), failures, tuple(work.skipped))


def pack_files(spark: SparkSession, path: str, seq_len: int, num_workers: int, world_size: int = 1, split: str | None = None,
               seed: int = 42, shuffle: bool = True) -> DataFrame:
    """Training sequences from the shard files of a prepared folder, by its manifest.

    Files that the manifest does not list are not read into sequences; of a wanted split without shards, ``train``
    stands in.
    """
    _, entries = sf.read_manifest(spark, f"{path}/manifest")
    if split:
        entries = sf.select_split(entries, split)
    lanes = as_written(reading_order(assign_workers(shard_list(entries), num_workers, world_size), seed, shuffle), "lanes")
    wanted = entries.select("split").distinct().limit(2).collect() if split else []
    chunks = sf.read_bin(spark, f"{path}/shards", split=wanted[0]["split"] if len(wanted) == 1 else None)
    return pack_chunks(chunks, lanes, seq_len)

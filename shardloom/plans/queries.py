"""One query per operator over the driver tables; keys match ``plans.oracle``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions.text import words
from shardloom.operators import encode as en
from shardloom.operators import metrics as me
from shardloom.operators import ngram, pack, report
from shardloom.operators import shards as sh
from shardloom.operators import split as sp
from shardloom.operators import vocab as vo
from shardloom import prepare as pr
from shardloom.plans import fixture as fx
from shardloom.session import as_written, discard, remove, scratch_path, shared_dir, sparing
from shardloom.sources import readers as rd
from shardloom.sources import shard_files as sf
from shardloom.sources.manifest_log import ManifestLog
from shardloom.spec import BASE_VOCAB, MIN_CHARS_CORPUS, MIN_CHARS_SAMPLE, VOCAB_SIZE, Mixture, SourceSpec
from shardloom.stages import Stages, file_marks, fingerprint
from shardloom.streaming import jobs
from shardloom.streaming.shard_writer import ShardWriter
from shardloom.streaming.stalls import run_stalls, stalls

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(ids) -> F.Column:
    return F.array_join(ids, " ")


# ------------------------------------------------------------------------------------------------ sources


@query
def scan_source(spark: SparkSession, d: str) -> DataFrame:
    return rd.scan_source(spark, fx.mixture(d).sources[1]).select("ord", "text", "lang")


@query
def read_mixture(spark: SparkSession, d: str) -> DataFrame:
    return rd.read_mixture(spark, fx.mixture(d)).select("mix_source", "source_ord", "ord", F.md5("text").alias("text_md5"))


@query
def failed_sources(spark: SparkSession, d: str) -> DataFrame:
    """A mixture with a missing source and one whose file is no parquet: the others are counted, failures are rows."""
    bad = scratch_path(spark, "bad-file")
    fx.table(spark, d, "region").select(F.col("r_name").alias("value")).coalesce(1).write.text(bad)
    broken = SourceSpec("broken", f"{d}/no_such_source.parquet", weight=1.0)
    corrupt = SourceSpec("corrupt", bad, weight=1.0, schema="id long, text string", options={"pathGlobFilter": "*.txt"})
    mix = Mixture((broken, *fx.mixture(d).sources[:2], corrupt, *fx.mixture(d).sources[2:]))
    docs, failures = rd.read_mixture_isolated(spark, mix)
    good = docs.groupBy("mix_source").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("state", F.lit("ok"))
    bad = failures.select("mix_source", F.lit(0).cast("long").alias("n_docs"), F.lit("failed").alias("state"))
    return good.unionByName(bad)


@query
def read_keyless(spark: SparkSession, d: str) -> DataFrame:
    """A source without a key: its rows in the order of the files."""
    spec = SourceSpec("text", f"{d}/documents.parquet", key=None)
    return rd.read_documents(spark, spec).select("ord", F.md5("text").alias("text_md5"))


@query
def read_string_key(spark: SparkSession, d: str) -> DataFrame:
    """A source whose key is a string: rows by the rank of their key."""
    spec = SourceSpec("web", f"{d}/pages.parquet", key="url", field="html")
    return rd.read_documents(spark, spec).select("ord", F.md5("text").alias("text_md5"))


@query
def filter_lang(spark: SparkSession, d: str) -> DataFrame:
    rows = rd.scan_source(spark, fx.mixture(d).sources[1])
    return rd.filter_language(rows, "fr").select("ord", "lang", F.length("text").alias("n_chars"))


@query
def project_text(spark: SparkSession, d: str) -> DataFrame:
    rows = rd.scan_source(spark, fx.mixture(d).sources[0])
    return rd.project_text(rows, "text")


@query
def render_chat(spark: SparkSession, d: str) -> DataFrame:
    return rd.read_documents(spark, fx.mixture(d).sources[2]).select("ord", "text")


@query
def min_length(spark: SparkSession, d: str) -> DataFrame:
    return fx.corpus(spark, d).select("mix_source", "ord", F.length("text").alias("n_chars"))


@query
def min_length_strict(spark: SparkSession, d: str) -> DataFrame:
    return fx.corpus(spark, d, MIN_CHARS_SAMPLE).select("mix_source", "ord", F.length("text").alias("n_chars"))


@query
def source_estimate(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.corpus(spark, d, MIN_CHARS_SAMPLE)
    limits = fx.mixture(d).table(spark).select("mix_source", F.lit(10_000).cast("long").alias("max_samples"))
    return report.source_estimate(docs, limits)


@query
def tokenizer_sample(spark: SparkSession, d: str) -> DataFrame:
    """The leading passing documents of each source; a source with 0 is skipped."""
    limits = spark.createDataFrame([("text", 500), ("code", 0), ("chat", 50)], "mix_source string, max_samples long")
    docs = fx.corpus(spark, d, MIN_CHARS_SAMPLE).select("mix_source", "ord", F.length("text").alias("n_chars"))
    return sp.first_documents(docs, limits)


# ------------------------------------------------------------------------------------------------ tokens


@query
def pretokenize(spark: SparkSession, d: str) -> DataFrame:
    w = words(F.col("text"))
    return fx.corpus(spark, d).select("mix_source", "ord", F.size(w).alias("n_words"),
                                      F.md5(F.array_join(w, "\u0001")).alias("words_md5"))


@query
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return vo.word_counts(fx.corpus(spark, d, MIN_CHARS_SAMPLE))


@query
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    pairs = vo.pair_counts(vo.coded_words(vo.word_counts(fx.corpus(spark, d, MIN_CHARS_SAMPLE))))
    return pairs.select((F.ascii("pair") - 1).alias("left_id"), (F.ascii(F.substring("pair", 2, 1)) - 1).alias("right_id"), "n")


@query
def byte_vocab(spark: SparkSession, d: str) -> DataFrame:
    """The merge-free vocabulary with the use each entry has in the corpus, counted over distinct words."""
    state = vo.coded_words(vo.word_counts(fx.corpus(spark, d, MIN_CHARS_SAMPLE)))
    used = state.select(F.explode(F.split("sym", "")).alias("c"), "freq").groupBy(
        (F.ascii("c") - 1).alias("id")).agg(F.sum("freq").alias("n_used"))
    return vo.byte_vocab(spark).join(used, "id", "left").select(
        "id", "token_hex", "is_special", F.coalesce("n_used", F.lit(0)).alias("n_used"))


def _tokenizer(spark: SparkSession, d: str, anew: bool = False, **size) -> tuple[DataFrame, DataFrame]:
    """``(vocab, merges)`` learned from these tables.

    They are kept in the shared folder under a mark of the tables' files, as a tokenizer is trained once and then used
    for a corpus: changed tables, or another size, train anew.
    """
    size = size or {"max_merges": fx.MERGES}
    mark = fingerprint([file_marks(spark, s.location) for s in fx.mixture(d).sources], MIN_CHARS_SAMPLE, size)

    def train(path: str) -> None:
        counts = as_written(vo.word_counts(fx.corpus(spark, d, MIN_CHARS_SAMPLE)), "word-counts")
        vo.save_tokenizer(vo.train_merges(counts, **size), spark, path)
        discard(counts)

    return vo.load_tokenizer(spark, Stages(spark, f"{shared_dir(spark)}/tokenizers").run(mark[:32], mark, train, anew))


@query
def bpe_merges(spark: SparkSession, d: str) -> DataFrame:
    """Trained here whatever was learned before."""
    return _tokenizer(spark, d, anew=True, max_merges=fx.LEARNED)[1]


@query
def bpe_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """The whole vocabulary of the published size, or as far as the corpus has pairs."""
    vocab, merges = _tokenizer(spark, d, anew=True, vocab_size=VOCAB_SIZE)
    return vocab.join(merges.withColumnRenamed("new_id", "id").groupBy("id").agg(F.min("rank").alias("rank")), "id", "left").select(
        "id", "token_hex", "is_special", "rank")


@query
def vocab(spark: SparkSession, d: str) -> DataFrame:
    """The learned vocabulary, saved and read back."""
    return _tokenizer(spark, d)[0]


@query
def encode_bytes(spark: SparkSession, d: str) -> DataFrame:
    docs = en.encode_bytes(fx.corpus(spark, d).filter("text <> ''"))
    return docs.select("mix_source", "ord", F.size("ids").alias("n_ids"), joined("ids").alias("ids"))


@query
def encode_special(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every document with special literals as one id each, and read as plain text."""
    text = F.col("text")
    return fx.corpus(spark, d).select(
        "mix_source", "ord", en.byte_token_count(text).alias("n_special"),
        en.byte_token_count(text, allow_special=False).alias("n_plain"),
        F.md5(joined(en.byte_ids(text))).alias("special_md5"),
        F.md5(joined(en.byte_ids(text, allow_special=False))).alias("plain_md5"),
    )


@query
def frame_docs(spark: SparkSession, d: str) -> DataFrame:
    ids = en.checked_uint16(F.col("ids"))
    return fx.encoded(spark, d).withColumn("ids", ids).select(
        "mix_source", "ord", "n_tokens", F.element_at("ids", 1).alias("first_id"),
        F.element_at("ids", -1).alias("last_id"), F.md5(joined("ids")).alias("ids_md5"))


@query
def encode_bpe(spark: SparkSession, d: str) -> DataFrame:
    """By a word dictionary that the run extends by the words it meets."""
    merges = _tokenizer(spark, d)[1]
    words = en.WordDictionary(spark, scratch_path(spark, "dictionary"), merges)
    out = en.encode_by_dictionary(fx.corpus(spark, d), ["mix_source", "ord"], words)
    return out.select("mix_source", "ord", F.size("ids").alias("n_ids"), joined("ids").alias("ids"))


@query
def encode_bpe_in_place(spark: SparkSession, d: str) -> DataFrame:
    out = en.encode_in_place(fx.corpus(spark, d), _tokenizer(spark, d)[1])
    return out.select("mix_source", "ord", F.size("ids").alias("n_ids"), joined("ids").alias("ids"))


@query
def decode_ids(spark: SparkSession, d: str) -> DataFrame:
    spelled, merges = _tokenizer(spark, d)
    docs = en.frame(en.encode_in_place(fx.corpus(spark, d), merges))
    text = en.decode_ids(F.col("ids"), en.vocab_spellings(spelled), skip_markers=False)
    return docs.select("mix_source", "ord", "n_tokens", text.alias("decoded"))


@query
def roundtrip(spark: SparkSession, d: str) -> DataFrame:
    spelled, merges = _tokenizer(spark, d)
    docs = en.encode_in_place(fx.corpus(spark, d), merges)
    return en.roundtrip(docs, en.vocab_spellings(spelled))


@query
def fertility(spark: SparkSession, d: str) -> DataFrame:
    return report.fertility(en.count_bytes(fx.corpus(spark, d)))


# ------------------------------------------------------------------------------------------------ split, budget, shards


@query
def train_val_split(spark: SparkSession, d: str) -> DataFrame:
    return fx.counted(spark, d).select("mix_source", "ord", "split")


def _budgets(spark: SparkSession, d: str) -> DataFrame:
    return sp.budgets(fx.mixture(d).table(spark), fx.MAX_TOKENS)


@query
def budgets(spark: SparkSession, d: str) -> DataFrame:
    """Budgets beside what each source holds."""
    held = fx.counted(spark, d).groupBy("mix_source").agg(F.sum("n_tokens").alias("available"))
    return _budgets(spark, d).join(held, "mix_source", "left").select(
        "mix_source", F.round("share", 6).alias("share"), "budget", F.coalesce("available", F.lit(0)).alias("available"))


def _within_budget(spark: SparkSession, d: str) -> DataFrame:
    return sp.budget_cut(fx.counted_once(spark, d), _budgets(spark, d))


@query
def budget_cut(spark: SparkSession, d: str) -> DataFrame:
    return _within_budget(spark, d).select("mix_source", "ord", "split", "n_tokens")


@query
def split_totals(spark: SparkSession, d: str) -> DataFrame:
    return report.split_totals(fx.counted(spark, d))


@query
def shards_greedy(spark: SparkSession, d: str) -> DataFrame:
    return sh.shards_greedy(fx.counted_once(spark, d), fx.SHARD_SIZE).select("mix_source", "split", "ord", "shard")


@query
def shards_offset(spark: SparkSession, d: str) -> DataFrame:
    return sh.shards_by_offset(fx.counted_once(spark, d), fx.SHARD_SIZE).select("mix_source", "split", "ord", "start_tok", "shard")


@query
def shard_totals(spark: SparkSession, d: str) -> DataFrame:
    totals = sh.shard_totals(sh.shards_by_offset(fx.counted_once(spark, d), fx.SHARD_SIZE))
    return totals.select("mix_source", "split", "shard", "num_tokens", "n_docs", "min_ord", "max_ord")


@query
def shard_numbering(spark: SparkSession, d: str) -> DataFrame:
    totals = sh.shard_totals(sh.shards_greedy(fx.counted_once(spark, d), fx.SHARD_SIZE))
    return sh.number_shards(totals, fx.SHARD_SIZE).select("mix_source", "split", "shard", "shard_idx", "num_tokens")


def _planned(thin: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shard of every document, and the shards' numbers, from narrow columns."""
    at = as_written(sh.shards_by_offset(thin, fx.SHARD_SIZE), "places")
    return at, sh.number_shards(sh.shard_totals(at), fx.SHARD_SIZE).select("mix_source", "split", "shard", "shard_idx")


def _placed(docs: DataFrame) -> DataFrame:
    """Encoded documents with their shard's index. Places are planned on the narrow columns and join the ids by key."""
    at, shards = _planned(docs.select("mix_source", "source_ord", "ord", "split", "n_tokens"))
    return sh.with_ids(at.join(shards, ["mix_source", "split", "shard"]).select("mix_source", "ord", "shard_idx"), docs)


@query
def shard_table(spark: SparkSession, d: str) -> DataFrame:
    """Documents written shard by shard and read back."""
    path = scratch_path(spark, "shards")
    sf.write_shard_table(_placed(fx.encoded_once(spark, d)).drop("source_ord"), path)
    back = sf.read_shard_table(spark, path, "ord long, n_tokens long, ids array<int>, shard_idx int")
    return back.select("mix_source", "split", "shard_idx", "ord", "n_tokens", F.md5(joined("ids")).alias("ids_md5"))


def _export(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """The folder of the encoded documents' shard files, and their entries."""
    path = scratch_path(spark, "bin")
    with sparing(spark):
        encoded = fx.encoded_in_parts(spark, d)
        at, shards = _planned(sf.read_parts(spark, encoded).drop("ids"))
        files = sf.export_in_turns(encoded, at, shards, path, Stages(spark, scratch_path(spark, "turns")))
    remove(spark, encoded)
    discard(at)
    return path, files


def _exported(spark: SparkSession, d: str) -> str:
    return _export(spark, d)[0]


@query
def export_bin(spark: SparkSession, d: str) -> DataFrame:
    return _export(spark, d)[1]


@query
def discover_shards(spark: SparkSession, d: str) -> DataFrame:
    good, _ = sf.discover_shards(spark, _exported(spark, d))
    return good.select("path", "num_tokens", "shard_idx", "source", "split")


@query
def read_shards(spark: SparkSession, d: str) -> DataFrame:
    chunks = sf.read_bin(spark, _exported(spark, d))
    w = F.aggregate("ids", F.lit(0).cast("long"), lambda a, t: a + t)
    return chunks.groupBy("source", "split", "shard_idx").agg(
        F.sum(F.size("ids")).alias("num_tokens"), F.sum(w).alias("id_sum"))


@query
def ingest_status(spark: SparkSession, d: str) -> DataFrame:
    """State of a finished export, seen a minute after its last file."""
    path = _exported(spark, d)
    last = sf.list_files(spark, path).agg(F.max("modificationTime").alias("t")).first()["t"]
    seen = F.lit(last) + F.expr("interval 1 minute")
    return sf.ingest_status(spark, path, seen, fx.SHARD_SIZE).select("n_files", "est_tokens", "state")


@query
def parse_shard_name(spark: SparkSession, d: str) -> DataFrame:
    names = fx.entries(fx.numbered(fx.counted_once(spark, d))).select(F.col("path").alias("name"))
    return names.select("name", sh.parse_shard_name(F.col("name")).alias("s")).select("name", "s.*")


def _manifest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    entries = as_written(fx.entries(fx.numbered(fx.counted_once(spark, d))), "entries")
    return sf.manifest(entries, "tokenizer", BASE_VOCAB, fx.SHARD_SIZE, fx.VAL_FRACTION), entries


@query
def manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest written, read back and flattened."""
    path = scratch_path(spark, "manifest")
    sf.write_manifest(*_manifest(spark, d), path)
    return sf.read_manifest(spark, path)[1]


@query
def manifest_versions(spark: SparkSession, d: str) -> DataFrame:
    """One commit per source; every entry with its version, and what the version before held."""
    entries = as_written(fx.entries(fx.numbered(fx.counted_once(spark, d))), "entries")
    log = ManifestLog(spark, scratch_path(spark, "log"))
    for s in fx.mixture(d).sources:
        log.commit(entries.filter(F.col("source") == s.name), "tokenizer", BASE_VOCAB, fx.SHARD_SIZE)
    held = [log.read(v)[0].select(F.lit(v).alias("version"), (F.col("total_train_tokens") + F.col("total_val_tokens")).alias("total")) for v in log.versions()]
    return log.added().join(F.broadcast(reduce(DataFrame.unionByName, held)), "version").select("version", "path", "num_tokens", "total")


@query
def require_shards(spark: SparkSession, d: str) -> DataFrame:
    kept = sf.require_shards(_manifest(spark, d)[1], "train")
    return kept.groupBy("split").agg(F.count(F.lit(1)).alias("n_shards"), F.sum("num_tokens").alias("n_tokens"))


@query
def resync_manifest(spark: SparkSession, d: str) -> DataFrame:
    entries = as_written(fx.entries(fx.numbered(fx.counted_once(spark, d))), "entries")
    row = sf.manifest_document(sf.resync_manifest(entries, "tokenizer", BASE_VOCAB), entries)
    paths = lambda s: F.array_join(F.col(f"{s}_shards.path"), ",").alias(f"{s}_paths")
    return row.select("vocab_size", "shard_size", "dtype", "total_train_tokens", "total_val_tokens", "val_fraction",
                      paths("train"), paths("val"))


@query
def select_split(spark: SparkSession, d: str) -> DataFrame:
    return sf.select_split(fx.entries(fx.numbered(fx.counted_once(spark, d))), "val").select("split", "path", "num_tokens")


@query
def manifest_drift(spark: SparkSession, d: str) -> DataFrame:
    """A manifest of an earlier, budgeted run against the shards of the full run."""
    docs = fx.counted_once(spark, d)
    earlier = fx.numbered(sp.budget_cut(docs, _budgets(spark, d)))
    named = lambda shards: fx.entries(shards).withColumnRenamed("path", "name")
    return report.manifest_drift(named(earlier), named(fx.numbered(docs)))


@query
def size_report(spark: SparkSession, d: str) -> DataFrame:
    totals = sh.shard_totals(sh.shards_by_offset(fx.counted_once(spark, d), fx.SHARD_SIZE))
    return sh.size_report(totals, ["mix_source", "split"])


@query
def mixture_report(spark: SparkSession, d: str) -> DataFrame:
    totals = report.split_totals(_within_budget(spark, d))
    return report.mixture_report(_budgets(spark, d), totals, fx.BATCH * fx.SEQ_LEN, fx.MAX_TOKENS)


@query
def progress(spark: SparkSession, d: str) -> DataFrame:
    out = report.progress(fx.counted_once(spark, d), 50, _budgets(spark, d), tokens_per_second=820_000.0)
    return rounded(out, 6, "elapsed_seconds", "eta_seconds")


@query
def corpus_overview(spark: SparkSession, d: str) -> DataFrame:
    """Sources to shards in one plan: documents, tokens and shards per source and split within budget."""
    placed = sh.shards_by_offset(_within_budget(spark, d), fx.SHARD_SIZE)
    totals = sh.shard_totals(placed).groupBy("mix_source", "split").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("num_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_shards"))
    whole = F.sum("n_tokens").over(Window.partitionBy("split"))
    return totals.join(F.broadcast(_budgets(spark, d)), "mix_source").select(
        "mix_source", "split", "n_docs", "n_tokens", "n_shards", F.round(F.col("share") * 100, 4).alias("target_pct"),
        F.round(F.col("n_tokens") / whole * 100, 4).alias("achieved_pct"))


# ------------------------------------------------------------------------------------------------ packing


@query
def worker_assign(spark: SparkSession, d: str) -> DataFrame:
    listed = pack.shard_list(fx.numbered(fx.counted_once(spark, d)))
    return pack.assign_workers(listed, fx.WORKERS).select("split", "shard_idx", "pos", "worker")


@query
def rank_assign(spark: SparkSession, d: str) -> DataFrame:
    listed = pack.shard_list(fx.numbered(fx.counted_once(spark, d)))
    return pack.assign_workers(listed, fx.WORKERS, fx.RANKS).select("split", "shard_idx", "pos", "rank", "worker")


@query
def shuffle_shards(spark: SparkSession, d: str) -> DataFrame:
    return fx.lanes(fx.numbered(fx.counted_once(spark, d))).select("split", "rank", "worker", "shard_idx", "read_pos", "stream_off")


@query
def epochs(spark: SparkSession, d: str) -> DataFrame:
    listed = pack.assign_workers(pack.shard_list(fx.numbered(fx.counted_once(spark, d))), fx.WORKERS, fx.RANKS)
    return pack.reading_order(pack.repeat_epochs(listed, 2), fx.SEED).select(
        "epoch", "split", "rank", "worker", "shard_idx", "read_pos")


@query
def sequence_count(spark: SparkSession, d: str) -> DataFrame:
    return pack.sequence_counts(fx.numbered(fx.counted_once(spark, d)), fx.SEQ_LEN, fx.RANKS)


def _sequences(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packed sequences, the shards in reading order, and the numbered shards."""
    docs = fx.encoded_once(spark, d)
    thin = docs.select("mix_source", "source_ord", "ord", "split", "n_tokens")
    at = as_written(sh.shards_by_offset(thin, fx.SHARD_SIZE), "places")
    shards = sh.number_shards(sh.shard_totals(at), fx.SHARD_SIZE)
    lanes = fx.lanes(shards)
    return pack.pack_sequences(docs, pack.stream_positions(at, lanes), fx.SEQ_LEN), lanes, shards


@query
def pack_sequences(spark: SparkSession, d: str) -> DataFrame:
    return _sequences(spark, d)[0].select("split", "rank", "worker", "seq_idx", F.md5(joined("input_ids")).alias("ids_md5"))


@query
def next_token_pairs(spark: SparkSession, d: str) -> DataFrame:
    labelled = pack.next_token_labels(_sequences(spark, d)[0])
    return labelled.select("split", "rank", "worker", "seq_idx", F.element_at("input_ids", 1).alias("first_id"),
                           F.element_at("labels", 1).alias("first_label"),
                           F.element_at("labels", -1).isNull().alias("last_unlabelled"),
                           F.md5(joined("labels")).alias("labels_md5"))


@query
def batches(spark: SparkSession, d: str) -> DataFrame:
    seqs, lanes, _ = _sequences(spark, d)
    return pack.with_batches(seqs, lanes, fx.SEQ_LEN, fx.BATCH).select("split", "rank", "worker", "batch_id", "seq_idx")


@query
def val_cap(spark: SparkSession, d: str) -> DataFrame:
    """Validation batches to run: those below the cap."""
    seqs, lanes, shards = _sequences(spark, d)
    cap = pack.validation_cap(shards, fx.SEQ_LEN, fx.BATCH).select("split", "max_batches")
    return pack.with_batches(seqs, lanes, fx.SEQ_LEN, fx.BATCH).join(F.broadcast(cap), "split").filter(F.col("batch_id") < F.col("max_batches")).select(
        "rank", "worker", "batch_id", "seq_idx", "max_batches")


@query
def pipeline_shards(spark: SparkSession, d: str) -> DataFrame:
    """The whole job - mixture, learned merges, exact fill, files, manifest - and what its files hold."""
    out = scratch_path(spark, "prepared")
    spelled, merges = _tokenizer(spark, d)
    done = pr.prepare(spark, fx.mixture(d), merges, spelled.count(), out)
    ids = F.aggregate("ids", F.lit(0).cast("long"), lambda a, t: a + t)
    held = sf.read_bin(spark, f"{out}/shards").groupBy("shard_idx").agg(F.sum(ids).alias("id_sum"))
    return done.entries.join(held, "shard_idx").select("split", "path", "num_tokens", "shard_idx", "source", "id_sum")


@query
def pack_from_files(spark: SparkSession, d: str) -> DataFrame:
    """Sequences from shard files by their manifest; the files hold byte ids in the parallel fill."""
    out = scratch_path(spark, "prepared")
    none = spark.createDataFrame([], vo.MERGE_SCHEMA)
    pr.prepare(spark, fx.mixture(d), none, BASE_VOCAB, out, fill="offset")
    seqs = pr.pack_files(spark, out, fx.SEQ_LEN, fx.WORKERS, fx.RANKS, seed=fx.SEED)
    return seqs.select("split", "rank", "worker", "seq_idx", F.md5(joined("input_ids")).alias("ids_md5"))


# ------------------------------------------------------------------------------------------------ metrics


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query
def weighted_loss(spark: SparkSession, d: str) -> DataFrame:
    return rounded(fx.steps(spark, d).groupBy("run_id").agg(me.weighted_loss().alias("loss")), 6, "loss")


@query
def perplexity(spark: SparkSession, d: str) -> DataFrame:
    """Both perplexity figures of every step; the infinite ones are flagged."""
    s = fx.steps(spark, d)
    full = me.perplexity_or_inf(F.col("loss"))
    infinite = full == F.lit(float("inf"))
    return s.select("run_id", "step", F.round(me.perplexity_capped(F.col("loss")), 2).alias("ppl_capped"),
                    infinite.alias("ppl_infinite"), F.when(~infinite, F.round(full, 2)).alias("ppl"))


@query
def rank_mean_loss(spark: SparkSession, d: str) -> DataFrame:
    return rounded(me.rank_mean_loss(fx.steps(spark, d), "run_id"), 6, "mean_loss", "weighted_loss", "perplexity")


@query
def bench_summary(spark: SparkSession, d: str) -> DataFrame:
    flops = me.flops_per_token(1280, 13, 3456)
    out = me.bench_summary(fx.steps(spark, d), 20, flops, 82.6)
    return rounded(out, 6, "step_time_ms", "data_wait_ms", "data_wait_pct", "tokens_per_sec", "peak_mem_gb", "mfu_pct")


@query
def mfu(spark: SparkSession, d: str) -> DataFrame:
    """Utilisation per run and interval, the device taken from a name per rank."""
    named = fx.steps(spark, d).withColumn("device", F.element_at(F.array(*map(F.lit, (
        "NVIDIA H100 80GB", "NVIDIA A100-SXM4", "NVIDIA GeForce RTX 4090", "Other"))), F.col("rank") + 1))
    flops = F.lit(float(me.flops_per_token(1280, 13, 3456)))
    out = named.groupBy("run_id", "device").agg((F.sum("tokens") / F.sum("step_time")).alias("tps"))
    peak = me.peak_tflops(F.col("device"))
    return out.select("run_id", "device", peak.alias("peak"), F.round(me.mfu_percent(F.col("tps"), flops, peak), 6).alias("mfu_pct"))


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    return me.interval_metrics(fx.steps(spark, d), 100)


@query
def interval_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = rounded(_intervals(spark, d), 4, "tokens_per_sec")
    return rounded(rounded(out, 9, "data_wait_ms"), 2, "perplexity")


@query
def metrics_long(spark: SparkSession, d: str) -> DataFrame:
    """Interval metrics appended to the run-partitioned table and read back."""
    path = scratch_path(spark, "metrics")
    sf.append_metrics(me.metrics_long(_intervals(spark, d)), path)
    places = {"train/tokens_per_sec": 4, "system/dataloader_wait_ms": 9, "train/perplexity": 2}
    value = F.col("value")
    for tag, n in places.items():
        value = F.when(F.col("tag") == tag, F.round("value", n)).otherwise(value)
    return spark.read.parquet(path).select("run_id", "tag", "step", value.alias("value"))


@query
def run_health(spark: SparkSession, d: str) -> DataFrame:
    return rounded(me.run_health(fx.steps(spark, d), 32768), 6, "early_loss", "final_loss", "first_minus_ln_vocab")


@query
def rolling_step_time(spark: SparkSession, d: str) -> DataFrame:
    return rounded(me.rolling_step_time(fx.steps(spark, d)), 12, "mean_step_time")


@query
def best_checkpoints(spark: SparkSession, d: str) -> DataFrame:
    series = fx.steps(spark, d).select("run_id", "step", F.col("loss").alias("val_loss"))
    return me.best_checkpoints(series)


@query
def retention_plan(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a checkpoint of its user's run; the low-valued ones are best checkpoints."""
    e = fx.table(spark, d, "events")
    name = F.when(F.col("value") < 5, F.lit("checkpoint_best.pt")).otherwise(
        F.format_string("checkpoint_step_%07d.pt", "event_id"))
    catalog = e.select(F.col("user_id").alias("run_id"), F.concat(F.lit("runs/"), "user_id", F.lit("/"), name).alias("path"))
    return me.retention_plan(catalog, 3, 100.0)


@query
def metrics_by_day(spark: SparkSession, d: str) -> DataFrame:
    return _windows(me.metrics_by_window(fx.points(spark, d), "1 day"))


def _windows(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "tag", "n", F.round("total", 4).alias("total"))


# ------------------------------------------------------------------------------------------------ n-grams


@query
def bigram_perplexity(spark: SparkSession, d: str) -> DataFrame:
    out = ngram.bigram_perplexity(fx.encoded(spark, d), BASE_VOCAB)
    return rounded(out, 6, "loss", "perplexity")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    counts = ngram.bigram_counts(fx.encoded(spark, d), [])
    scores = counts.select(F.col("prev").alias("context"), F.col("next").alias("token"), F.log("n").alias("score"))
    return ngram.topk_nucleus(scores, 5, 0.9, 0.8)


@query
def topk_nucleus(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_candidates(spark, d), 6, "prob")


@query
def sample_next(spark: SparkSession, d: str) -> DataFrame:
    return ngram.sample_next(_candidates(spark, d), 7)


# ------------------------------------------------------------------------------------------------ streaming


@query
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents")
    stream = jobs.file_stream(spark, d, docs.schema, "documents.parquet")
    kept = stream.filter(rd.long_enough(F.col("text"), 20))
    counted = en.count_bytes(kept).select(F.col("doc_id").alias("ord"), "n_tokens")
    return jobs.ingest(counted)


@query
def stream_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Shard entries arrive as files; the manifest follows them."""
    entries = fx.entries(fx.numbered(fx.counted_once(spark, d)))
    landing = scratch_path(spark, "landing")
    entries.write.parquet(landing)
    out = scratch_path(spark, "follow")
    jobs.follow_manifest(jobs.file_stream(spark, landing, entries.schema), f"{out}/manifest", f"{out}/state", "tokenizer",
                         BASE_VOCAB)
    return sf.read_manifest(spark, f"{out}/manifest")[1]


@query
def stream_shards(spark: SparkSession, d: str) -> DataFrame:
    """The text source arrives as files of documents; shards are closed as they fill."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "written")
    step = docs.agg(F.max("doc_id")).first()[0] // 3 + 1
    for k in range(3):
        docs.filter((F.col("doc_id") >= k * step) & (F.col("doc_id") < (k + 1) * step)).coalesce(1).write.mode("append").parquet(landing)
    rows = jobs.file_stream(spark, landing, docs.schema, files_per_trigger=1).filter(rd.long_enough(F.col("text"), MIN_CHARS_CORPUS))
    named = rows.select(F.lit("text").alias("mix_source"), F.lit(0).alias("source_ord"), F.col("doc_id").alias("ord"), "text")
    encoded = sp.with_split(en.frame(en.encode_bytes(named)), fx.VAL_FRACTION, fx.SEED)
    writer = ShardWriter(spark, out, fx.SHARD_SIZE, "tokenizer", BASE_VOCAB)
    writer.follow(encoded.drop("text"), f"{out}/checkpoint")
    writer.finish()
    return writer.closed().select("mix_source", "split", "shard", "shard_idx", "num_tokens", "n_docs", "min_ord", "max_ord")


@query
def stream_metrics(spark: SparkSession, d: str) -> DataFrame:
    events = fx.table(spark, d, "events")
    raw = jobs.file_stream(spark, d, events.schema, "events.parquet")
    points = raw.select(F.col("event_type").alias("tag"), F.col("ts").cast("timestamp").alias("ts"), "value")
    return _windows(jobs.ingest(jobs.windowed_metrics(points), "windows"))


@query
def stream_best(spark: SparkSession, d: str) -> DataFrame:
    events = fx.table(spark, d, "events")
    raw = jobs.file_stream(spark, d, events.schema, "events.parquet")
    points = raw.select(F.col("event_type").alias("run_id"), F.col("event_id").alias("step"), "value")
    return jobs.ingest(jobs.best_so_far(points), "best", one_batch=True)


@query
def stream_stalls(spark: SparkSession, d: str) -> DataFrame:
    """Silences of two days or more, every user a run."""
    events = fx.table(spark, d, "events")
    raw = jobs.file_stream(spark, d, events.schema, "events.parquet")
    points = raw.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), "value", F.col("ts").cast("timestamp").alias("ts"))
    found, out = stalls(points, fx.SILENT_SECONDS), scratch_path(spark, "stalls")
    run_stalls(found, out, scratch_path(spark, "stalls-state"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return spark.read.schema(found.schema).parquet(out).select("run_id", shown("last_ts"), shown("silent_from"), "best", "best_step", "n_seen")

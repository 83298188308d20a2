import json
import re

import pytest
from pyspark.sql import functions as F

from shardloom import prepare as pr
from shardloom.operators import encode as en
from shardloom.operators import split as sp
from shardloom.operators import vocab as vo
from shardloom.plans import fixture as fx
from shardloom.session import as_written, file_uri
from shardloom.sources import readers as rd
from shardloom.sources import shard_files as sf
from shardloom.sources import tokenizer_json as tj
from shardloom.spec import SPECIAL_TOKENS, Mixture, SourceSpec

SF = "/root/testdata/sf0.001"


def texts(rows):
    return [r["text"] for r in sorted(rows, key=lambda r: r["ord"])]


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_order_without_an_integer_key(spark, tmp_path, parts):
    rows = [(f"urn:uuid:{(i * 7919) % 1000:04d}", f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id string, text string").repartition(parts)
    df.write.parquet(str(tmp_path / "s"))
    by_key = rd.read_documents(spark, SourceSpec("s", str(tmp_path / "s"), key="id"))
    got = [(r["ord"], r["text"]) for r in by_key.collect()]
    want = [t for _, t in sorted(rows)]
    assert sorted(got) == list(enumerate(want))
    by_file = rd.read_documents(spark, SourceSpec("s", str(tmp_path / "s"), key=None)).collect()
    assert sorted(r["ord"] for r in by_file) == list(range(300))
    stored = [r["text"] for f in sorted((tmp_path / "s").glob("*.parquet"), key=lambda f: f.as_uri()) for r in spark.read.parquet(str(f)).collect()]
    assert texts(by_file) == stored


def test_real_mixture_shapes(spark, tmp_path):
    spark.createDataFrame([("urn:1", "plain text of one document"), ("urn:0", "another text of a document")], "id string, text string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([("def f(): return 12345678", "python"), ("fn main() {} // not this", "rust")], "solution string, lang string").coalesce(1).write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([([("user", "hello there"), ("assistant", "good day")],)], "messages array<struct<role: string, content: string>>").write.parquet(str(tmp_path / "m"))
    mix = Mixture((SourceSpec("text", str(tmp_path / "t"), weight=60), SourceSpec("code", str(tmp_path / "c"), key=None, field="solution", filter_lang="python", weight=25),
                   SourceSpec("chat", str(tmp_path / "m"), key=None, field="messages", weight=15)), tokens_per_shard=10, val_fraction=0.0)
    got = sorted((r["mix_source"], r["ord"], r["text"]) for r in rd.read_mixture(spark, mix).collect())
    assert got == [("chat", 0, "<|user|>\nhello there\n<|assistant|>\ngood day"), ("code", 0, "def f(): return 12345678"),
                   ("text", 0, "another text of a document"), ("text", 1, "plain text of one document")]
    merges = vo.train_merges(vo.word_counts(rd.read_mixture(spark, mix)), max_merges=20)
    done = pr.prepare(spark, mix, merges.table(spark), merges.vocab_size, str(tmp_path / "out"))
    assert done.failures.count() == 0 and [r["source"] for r in done.entries.orderBy("shard_idx").collect()] == ["text", "text", "code", "chat"]


def test_turn_tables_have_no_language(spark):
    with pytest.raises(ValueError):
        rd.scan_source(spark, SourceSpec("chat", f"{SF}/conversations.parquet", key="conv_id", field="messages", turn_rows=True, filter_lang="en"))


def test_sources_that_fail_while_they_are_read(spark, tmp_path):
    good = spark.range(60).select("id", F.concat(F.lit("a text of some length "), F.col("id")).alias("text")).coalesce(1)
    for name in ("good", "torn"):
        good.write.parquet(str(tmp_path / name))
    spark.range(60, 120).select("id", F.repeat(F.lit("x"), 300).alias("text")).coalesce(1).write.mode("append").parquet(str(tmp_path / "torn"))
    last = sorted((tmp_path / "torn").glob("*.parquet"))[-1]
    whole = last.read_bytes()
    last.write_bytes(whole[:len(whole) // 2] + bytes(len(whole) - len(whole) // 2))
    mix = Mixture((SourceSpec("torn", str(tmp_path / "torn"), weight=1.0, schema="id long, text string"), SourceSpec("gone", str(tmp_path / "no"), weight=1.0),
                   SourceSpec("good", str(tmp_path / "good"), weight=1.0)), tokens_per_shard=500, val_fraction=0.0)
    none = spark.createDataFrame([], vo.MERGE_SCHEMA)
    done = pr.prepare(spark, mix, none, 263, str(tmp_path / "out"))
    assert sorted(r["mix_source"] for r in done.failures.collect()) == ["gone", "torn"]
    listed = done.entries.orderBy("shard_idx").collect()
    assert {r["source"] for r in listed} == {"good"} and [r["shard_idx"] for r in listed] == list(range(len(listed)))


def test_files_and_manifest_to_sequences(spark, tmp_path):
    merges = vo.train_merges(spark.createDataFrame([(" the", 9), ("ing", 5)], "word string, freq long"), max_merges=4)
    mix = fx.mixture(SF)
    for out in (str(tmp_path / "plain"), "file:" + str(tmp_path / "one"), "file://" + str(tmp_path / "three")):
        done = pr.prepare(spark, mix, merges.table(spark), merges.vocab_size, out, max_tokens=200_000)
        good, bad = sf.discover_shards(spark, f"{out}/shards")
        assert bad.count() == 0 and sorted(map(tuple, good.select(*sf.ENTRY_COLUMNS).collect())) == sorted(map(tuple, done.entries.select(*sf.ENTRY_COLUMNS).collect()))
        seqs = pr.pack_files(spark, out, 64, 3, 2)
        assert seqs.count() == seqs.filter(F.size("input_ids") == 64).count() > 100
        lanes = seqs.groupBy("split", "rank", "worker").agg(F.count("*").alias("n"), F.max("seq_idx").alias("m")).collect()
        assert all(r["m"] + 1 == r["n"] for r in lanes)
        assert {r["split"] for r in pr.pack_files(spark, out, 64, 1, split="val").select("split").distinct().collect()} == {"val"}
    held = done.entries.groupBy("source").agg(F.sum("num_tokens").alias("n")).collect()
    longest = 70_000  # the document that crosses the budget is kept
    for r in held:
        assert r["n"] <= {"text": 120_000, "code": 50_000, "chat": 30_000}[r["source"]] + longest


def test_paths_are_named_as_spark_resolves_them(spark, tmp_path):
    for given in (str(tmp_path / "a"), "file:" + str(tmp_path / "a"), "file:///" + str(tmp_path / "a").lstrip("/")):
        assert file_uri(spark, given) == "file://" + str(tmp_path / "a")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    assert file_uri(spark, "viewfs://store/in/x") == "viewfs://store/in/x"


def test_tokenizer_document(spark, tmp_path):
    tk = pytest.importorskip("tokenizers")
    docs = as_written(fx.corpus(spark, SF, 21), "docs")
    merges = vo.train_merges(as_written(vo.word_counts(docs), "counts"), max_merges=80)
    path = str(tmp_path / "tokenizer.json")
    tj.write_tokenizer_json(spark, merges, path)
    vocab, table = tj.read_tokenizer_json(spark, path)
    assert sorted(map(tuple, table.collect())) == merges.rows
    assert sorted(map(tuple, vocab.collect())) == sorted(map(tuple, merges.vocab(spark).collect()))
    library = tk.Tokenizer.from_file(path)
    rows = docs.limit(60).collect()
    got = {(r["mix_source"], r["ord"]): r["ids"] for r in en.encode_in_place(docs, table).collect()}
    for r in rows:
        assert got[(r["mix_source"], r["ord"])] == library.encode(r["text"], add_special_tokens=False).ids
        framed = library.encode(r["text"])  # a reader of the file frames by it
        assert framed.ids == [1, *got[(r["mix_source"], r["ord"])], 2]
        assert library.decode(framed.ids, skip_special_tokens=False) == f"<s>{r['text']}</s>"
    assert library.model.unk_token == "<unk>"
    old = json.loads((tmp_path / "tokenizer.json").read_text())
    old["model"]["merges"] = [" ".join(m) for m in old["model"]["merges"]]
    assert tj.parse_tokenizer(old)[1] == merges.rows
    assert len(tj.CHAR_OF_BYTE) == 256 == len(tj.BYTE_OF_CHAR) and old["model"]["vocab"][SPECIAL_TOKENS[0]] == 0


def exchanges(df):
    """Keys and columns of every exchange of the plan, before adaptive execution."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+\([^)]*\))", plan), plan


def test_leading_rows_are_read_behind_a_bound(spark):
    limits = spark.createDataFrame([("text", 20), ("code", 0), ("chat", None)], "mix_source string, max_samples long")
    docs = fx.corpus(spark, SF, 21)
    lead = sp.first_documents(docs, limits)
    got = {r["mix_source"]: r["n"] for r in lead.groupBy("mix_source").agg(F.count("*").alias("n")).collect()}
    assert got == {"text": 20, "chat": docs.filter("mix_source = 'chat'").count()}
    found, plan = exchanges(lead.filter("mix_source = 'text'"))
    assert not found and re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(doc_id,", plan) and plan.count("FileScan") <= 2


def shard_bytes(out):
    return {f.name: f.read_bytes() for f in (out / "shards").glob("*.bin")}


def test_a_run_that_was_ended_goes_on(spark, tmp_path, monkeypatch):
    """Ended in every stage in turn, a rerun writes the same bytes and skips what was finished."""
    merges = spark.createDataFrame([], vo.MERGE_SCHEMA)
    run = lambda out, **more: pr.prepare(spark, fx.mixture(SF), merges, 263, str(out), **more)
    done = run(tmp_path / "whole")
    assert done.skipped == ()
    whole, entries = shard_bytes(tmp_path / "whole"), sorted(map(tuple, done.entries.collect()))
    assert run(tmp_path / "whole").skipped == pr.STAGES

    class Ended(Exception):
        pass

    for k, name in enumerate(pr.STAGES):
        original = pr.Stages.run

        def ended(self, stage, mark, make, anew=False, name=name):
            def half(path):
                make(path)
                raise Ended

            return original(self, stage, mark, half if stage == name else make, anew)

        monkeypatch.setattr(pr.Stages, "run", ended)
        if k == 0:
            with pytest.raises(Ended):
                run(tmp_path / "cut")
        else:
            with pytest.raises(Ended):
                run(tmp_path / "cut")
        monkeypatch.setattr(pr.Stages, "run", original)
    again = run(tmp_path / "cut")
    assert again.skipped == pr.STAGES[:-1]
    assert shard_bytes(tmp_path / "cut") == whole and sorted(map(tuple, again.entries.collect())) == entries
    # Other settings start anew.
    assert run(tmp_path / "cut", min_chars=500).skipped == ()


def test_changed_files_are_read_anew(spark, tmp_path):
    src = tmp_path / "src"
    spark.createDataFrame([(1, "a text that is long enough to stay")], "id long, text string").write.parquet(str(src))
    mix = Mixture((SourceSpec("s", str(src), weight=1.0),), tokens_per_shard=100, val_fraction=0.0)
    merges = spark.createDataFrame([], vo.MERGE_SCHEMA)
    first = pr.prepare(spark, mix, merges, 263, str(tmp_path / "out")).entries.agg(F.sum("num_tokens")).first()[0]
    spark.createDataFrame([(2, "another text that is long enough")], "id long, text string").write.mode("append").parquet(str(src))
    later = pr.prepare(spark, mix, merges, 263, str(tmp_path / "out"))
    assert later.skipped == () and later.entries.agg(F.sum("num_tokens")).first()[0] > first


def test_one_exchange_of_ids(spark):
    encoded = fx.encoded_once(spark, SF)
    at, shards = pr.shard_places(encoded.drop("ids"), fx.SHARD_SIZE, "exact")
    numbers = as_written(at.join(shards.select("mix_source", "split", "shard", "shard_idx"), ["mix_source", "split", "shard"])
                         .select("mix_source", "ord", "shard_idx"), "numbers")
    from shardloom.operators.shards import with_ids

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, _ = exchanges(with_ids(numbers, encoded))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 2 and all("mix_source" in x and "ord" in x for x in found)  # one for the ids, one for the narrow side


def test_texts_and_ids_go_when_they_are_used_up(spark, tmp_path):
    done = pr.prepare(spark, fx.mixture(SF), spark.createDataFrame([], vo.MERGE_SCHEMA), 263, str(tmp_path / "out"), fill="offset")
    work = tmp_path / "out" / "work"
    assert not list(work.glob("sources/docs")) and not list(work.glob("encoded/part=*")) and list(work.glob("encoded.done"))
    assert sum(f.stat().st_size for f in (tmp_path / "out" / "shards").glob("*.bin")) == 2 * done.entries.agg(F.sum("num_tokens")).first()[0]
    # Without the mark of the encoded table its texts are read once more.
    whole = shard_bytes(tmp_path / "out")
    for name in ("encoded", "entries"):
        (work / f"{name}.done").unlink()
    again = pr.prepare(spark, fx.mixture(SF), spark.createDataFrame([], vo.MERGE_SCHEMA), 263, str(tmp_path / "out"), fill="offset")
    assert again.skipped == ("thin", "places", "shards", "manifest") and shard_bytes(tmp_path / "out") == whole

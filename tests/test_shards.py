import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom import session
from shardloom.operators import encode as en
from shardloom.operators import pack, report
from shardloom.operators import prefix as px
from shardloom.operators import shards as sh
from shardloom.operators import split as sp
from shardloom.plans import fixture as fx
from shardloom.plans.queries import QUERIES
from shardloom.session import as_written
from shardloom.sources import readers as rd
from shardloom.sources import shard_files as sf
from shardloom.spec import Mixture, SourceSpec
from shardloom.stages import Stages
from tests.oracle_check import table_of

DOC = "mix_source string, source_ord int, split string, ord long, n_tokens long"


def docs_of(spark, lengths, source="a", split="train", position=0):
    return spark.createDataFrame([(source, position, split, i * 3, n) for i, n in enumerate(lengths)], DOC)


def fill(lengths, size):
    out, held, k = [], 0, 0
    for n in lengths:
        out.append(k)
        held += n
        if held >= size:
            k, held = k + 1, 0
    return out


@pytest.mark.parametrize("size,segment,fan_in", [(50, 2, 2), (50, 1, 2), (200, 4, 3), (30, 16, 32)])
def test_greedy_fill_equals_the_loop(spark, size, segment, fan_in):
    rng = random.Random(size)
    rows, want = [], {}
    for s in ("hot", "cold"):  # one source with most of the rows, and documents longer than whole segments
        lengths = [rng.choice([3, 5, 7, 22, 40, rng.choice([9, 1500])]) for _ in range(500 if s == "hot" else 60)]
        for i, (n, k) in enumerate(zip(lengths, fill(lengths, size))):
            rows.append((s, 0, "train", i * 3, n))
            want[s, i * 3] = k
    df = spark.createDataFrame(rows, DOC)
    out = sh.shards_greedy(df, size, bits=5, segment_shards=segment, fan_in=fan_in)
    assert {(r["mix_source"], r["ord"]): r["shard"] for r in out.collect()} == want


def test_greedy_example_and_offset_fill(spark):
    df = docs_of(spark, [6, 6, 3, 9])
    got = [r["shard"] for r in sh.shards_greedy(df, 10).orderBy("ord").collect()]
    assert got == [0, 0, 1, 1]
    offset = [(r["start_tok"], r["shard"]) for r in sh.shards_by_offset(df, 10).orderBy("ord").collect()]
    assert offset == [(0, 0), (6, 0), (12, 1), (15, 1)]


@pytest.mark.parametrize("budget,kept", [(8, 2), (7, 2), (9, 3), (None, 3), (0, 0)])
def test_budget(spark, budget, kept):
    df = docs_of(spark, [4, 4, 4])
    limits = spark.createDataFrame([("a", budget)], "mix_source string, budget long")
    assert sp.budget_cut(df, limits, bits=1).count() == kept


def test_budget_overshoot_stays_below_the_longest_document(spark):
    rng = random.Random(5)
    lengths = [rng.randint(3, 90) for _ in range(400)]
    df = docs_of(spark, lengths)
    for budget in (1, 500, 7000, sum(lengths), sum(lengths) + 1):
        limits = spark.createDataFrame([("a", budget)], "mix_source string, budget long")
        got = sp.budget_cut(df, limits, bits=4).agg(F.sum("n_tokens")).first()[0]
        assert min(budget, sum(lengths)) <= got < budget + max(lengths)


def test_prefix_scan_with_gaps_and_negative_keys(spark):
    keys = [-70000, -3, 0, 5, 65536, 2**33, 2**40]
    df = spark.createDataFrame([("a", k, 1 + i) for i, k in enumerate(keys)], "g string, k long, v long")
    out = px.exclusive_fold(df, "v", ["g"], "k", "before").orderBy("k").collect()
    assert [r["before"] for r in out] == [0, 1, 3, 6, 10, 15, 21]
    low = px.exclusive_fold(df.withColumn("v", -F.col("v")), "v", ["g"], "k", "low", px.MIN).orderBy("k").collect()
    assert [r["low"] for r in low] == [None, -1, -2, -3, -4, -5, -6]


def test_trailing_mean_over_bucket_borders(spark):
    df = spark.createDataFrame([("r", i * 2, float(i)) for i in range(50)], "run_id string, step long, v double")
    out = px.trailing_mean(df, "v", ["run_id"], "step", 7, "m", span=8).orderBy("step").collect()
    want = [sum(range(max(0, i - 6), i + 1)) / min(i + 1, 7) for i in range(50)]
    assert [round(r["m"], 9) for r in out] == [round(w, 9) for w in want]


def test_split_is_stable_when_a_source_is_added(spark):
    a, b = docs_of(spark, range(3, 400)), docs_of(spark, range(3, 300), source="b", position=1)
    alone = sp.with_split(a.drop("split"), 0.2).collect()
    joined = sp.with_split(a.unionByName(b).drop("split"), 0.2).filter("mix_source = 'a'").collect()
    assert sorted(map(tuple, alone)) == sorted(map(tuple, joined))
    assert 40 < sum(r["split"] == "val" for r in alone) < 120


def numbered(spark, df, size):
    return sh.number_shards(sh.shard_totals(sh.shards_greedy(df, size)), size)


def test_numbering_shares_one_counter_and_puts_tails_last(spark):
    df = docs_of(spark, [10, 10, 4]).unionByName(
        docs_of(spark, [3, 12, 2], split="val").withColumn("ord", F.col("ord") + 1)).unionByName(
        docs_of(spark, [10], source="c", position=2))
    got = {(r["mix_source"], r["split"], r["shard"]): r["shard_idx"] for r in numbered(spark, df, 10).collect()}
    assert got == {("a", "train", 0): 0, ("a", "train", 1): 1, ("a", "val", 0): 2, ("a", "train", 2): 3,
                   ("a", "val", 1): 4, ("c", "train", 0): 5}


def with_ids(df):
    return df.withColumn("ids", F.transform(F.sequence(F.lit(1), F.col("n_tokens").cast("int")),
                                            lambda i: (F.col("ord") * 100 + i).cast("int")))


def test_packing_example_and_conservation(spark):
    df = with_ids(docs_of(spark, [3, 4, 5]))
    placed = sh.shards_by_offset(df, 1000)
    lanes = pack.reading_order(pack.assign_workers(pack.shard_list(
        sh.number_shards(sh.shard_totals(placed), 1000)), 1), shuffle=False)
    seqs = pack.pack_sequences(df, pack.stream_positions(placed, lanes), 5).orderBy("seq_idx").collect()
    flat = [t for r in df.orderBy("ord").collect() for t in r["ids"]]
    assert [r["input_ids"] for r in seqs] == [flat[:5], flat[5:10]]

    rng = random.Random(1)
    many = with_ids(docs_of(spark, [rng.randint(3, 70) for _ in range(150)]))
    placed = sh.shards_by_offset(many, 200, bits=4)
    shards = sh.number_shards(sh.shard_totals(placed), 200)
    lanes = pack.reading_order(pack.assign_workers(pack.shard_list(shards), 3, 2))
    seqs = pack.pack_sequences(many, pack.stream_positions(placed, lanes), 16)
    want = pack.sequences_per_worker(lanes, 16).agg(F.sum("n_sequences")).first()[0]
    tokens = seqs.select(F.explode("input_ids").alias("t"))
    assert seqs.count() == want and tokens.count() == want * 16 == tokens.distinct().count()
    assert lanes.select("rank", "worker").distinct().count() == 6  # no idle reader
    labels = pack.next_token_labels(seqs).first()
    assert labels["labels"] == labels["input_ids"][1:] + [None]
    batches = pack.with_batches(seqs, lanes, 16, 4).groupBy("rank", "worker", "batch_id").count()
    assert batches.filter("count <> 4").count() == 0


@pytest.mark.parametrize("key", ["budget_cut", "shards_greedy", "pack_sequences", "encode_bpe", "rolling_step_time"])
def test_results_do_not_depend_on_partitioning(spark, key):
    seen = []
    for n in ("1", "4", "37"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = QUERIES[key](spark, "/root/testdata/sf0.001")
        seen.append(table_of(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1] == seen[2]


def test_bin_files(spark, tmp_path):
    df = with_ids(docs_of(spark, [6, 6, 3])).withColumn("shard_idx", (F.col("ord") > 3).cast("int"))
    out = str(tmp_path / "bin")
    for _ in range(2):  # a second run replaces the files
        made = sf.export_bin(df, out).collect()
    assert sorted((r["path"], r["num_tokens"]) for r in made) == [("a_train_shard_0000.bin", 12), ("a_train_shard_0001.bin", 3)]
    (tmp_path / "bin" / "a_train_shard_0007.bin").write_bytes(b"123")
    (tmp_path / "bin" / "a_train_shard_0008.bin").write_bytes(b"")
    (tmp_path / "bin" / "other.bin").write_bytes(b"12")
    (tmp_path / "bin" / "a_val_shard_0042.bin").write_bytes(b"\x01\x00\xff\xff")
    good, bad = sf.discover_shards(spark, out)
    assert sorted((r["path"], r["num_tokens"], r["split"]) for r in good.collect()) == [
        ("a_train_shard_0000.bin", 12, "train"), ("a_train_shard_0001.bin", 3, "train"), ("a_val_shard_0042.bin", 2, "val")]
    assert [r["path"] for r in bad.collect()] == ["a_train_shard_0007.bin"]
    chunks = sf.read_bin(spark, out, chunk=5).orderBy("split", "shard_idx", "start_tok").collect()
    flat = [t for r in df.orderBy("ord").collect() for t in r["ids"]]
    assert [t for r in chunks if r["split"] == "train" for t in r["ids"]] == flat
    assert [r["ids"] for r in chunks if r["split"] == "val"] == [[1, 65535]]
    now = F.current_timestamp()
    assert sf.ingest_status(spark, out, now).first()["state"] == "ACTIVE"
    assert sf.ingest_status(spark, out, now + F.expr("interval 6 minutes")).first()["state"] == "MAYBE STALLED"


def test_shards_are_written_as_a_stream(spark, tmp_path, request):
    """Rows come sorted, a few at a time; a shard may lie over several batches, and no shard is a group of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "3")
    request.addfinalizer(lambda: spark.conf.unset(key))
    rows = [(s, p, k, s * 1000 + i, [s * 100 + i % 7] * (i % 4)) for s, p in ((0, "train"), (1, "val")) for k in range(9) for i in range(k, 90, 9)]
    docs = spark.createDataFrame([(f"s{s}", p, k + 9 * s, o, ids) for s, p, k, o, ids in rows],
                                 "mix_source string, split string, shard_idx int, ord long, ids array<int>").repartition(5)
    made = sf.export_bin(docs, str(tmp_path / "bin"))
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()
    got = {(r["source"], r["split"], r["shard_idx"]): (r["path"], r["num_tokens"]) for r in made.collect()}
    assert len(got) == 18
    for s, p in ((0, "train"), (1, "val")):
        for k in range(9):
            want = [t for r in sorted(r for r in rows if (r[0], r[2]) == (s, k)) for t in r[4]]
            path, n = got[f"s{s}", p, k + 9 * s]
            assert n == len(want) and (tmp_path / "bin" / path).read_bytes() == b"".join(t.to_bytes(2, "little") for t in want)
    with pytest.raises(Exception, match="outside 0..65535"):
        sf.export_bin(docs.withColumn("ids", F.array(F.lit(65536))), str(tmp_path / "bad")).collect()


def test_packed_tokens(spark):
    for tokens in ([], [0], [65535, 0, 256, 255], list(range(60_000, 65_536, 3))):
        assert en.unpack(en.pack(np.array(tokens, np.int64))).tolist() == tokens
    rows = spark.createDataFrame([(1, [5, 6]), (2, []), (3, None), (4, [65535])], "k int, ids array<int>")
    got = {r["k"]: en.unpack(bytes(r["p"])).tolist() for r in rows.select("k", en.packed(F.col("ids")).alias("p")).collect()}
    assert got == {1: [5, 6], 2: [], 3: [], 4: [65535]}
    twice = rows.select("k", en.packed(F.col("ids")).alias("p")).select("k", en.unpacked(F.array("p", "p")).alias("ids"))
    assert {r["k"]: r["ids"] for r in twice.collect()} == {1: [5, 6, 5, 6], 2: [], 3: [], 4: [65535, 65535]}


def parted(spark, path, n=240):
    """Documents of two sources in parts of the keys, and what each shard file must hold."""
    rng = random.Random(7)
    rows = [("a" if i % 3 else "b", int(i % 3 == 0), 10 * i, "val" if i % 7 == 0 else "train", [i] * rng.randint(3, 70)) for i in range(n)]
    docs = spark.createDataFrame([(*r, "x" * 9, len(r[4])) for r in rows],
                                 "mix_source string, source_ord int, ord long, split string, ids array<int>, text string, n_tokens long")
    bounds = sf.part_bounds(docs, size=9 * n // 8, most=16)
    assert {s: len(cuts) for s, cuts in bounds.items()} == {"a": 7, "b": 7} and all(c == sorted(c) for c in bounds.values())
    sf.write_parts(docs.repartition(3), bounds, path)
    at = as_written(sh.shards_by_offset(sf.read_parts(spark, path).drop("ids"), 100), "places")
    shards = as_written(sh.number_shards(sh.shard_totals(at), 100), "shards")
    ids = {(r[0], r[2]): r[4] for r in rows}
    want = {}
    for r in at.join(shards.select("mix_source", "split", "shard", "shard_idx"), ["mix_source", "split", "shard"]).orderBy("ord").collect():
        name = f"{r['mix_source']}_{r['split']}_shard_{r['shard_idx']:04d}.bin"
        want[name] = want.get(name, b"") + b"".join(t.to_bytes(2, "little") for t in ids[r["mix_source"], r["ord"]])
    return at, shards, want


@pytest.mark.parametrize("sent", [0, 1000])
def test_parts_are_exported_in_turns(spark, tmp_path, monkeypatch, sent):
    """Shards over the ends of parts are whole, parts go as they have been read, and an ended run goes on."""
    monkeypatch.setattr(sf, "SENT_PLACES", sent)
    at, shards, want = parted(spark, str(tmp_path / "parts"))
    read = lambda: {f.name: f.read_bytes() for f in (tmp_path / "bin").glob("*.bin")}
    kept = lambda: sorted(int(f.name[5:]) for f in (tmp_path / "parts").glob("part=*"))
    assert kept() == list(range(8))

    class Ended(Stages):
        def run(self, name, mark, make, anew=False):
            if name == "5":
                raise KeyboardInterrupt
            return super().run(name, mark, make, anew)

    with pytest.raises(KeyboardInterrupt):
        sf.export_in_turns(str(tmp_path / "parts"), at, shards, str(tmp_path / "bin"), Ended(spark, str(tmp_path / "turns")), "m")
    left = kept()
    assert 0 < left[0] < 5 and left[-1] == 7 and 0 < len(read()) < len(want)
    turns = Stages(spark, str(tmp_path / "turns"))
    made = sf.export_in_turns(str(tmp_path / "parts"), at, shards, str(tmp_path / "bin"), turns, "m").collect()
    assert turns.skipped == ["0", "1", "2", "3", "4"] and read() == want and kept()[0] > left[0]
    assert sorted((r["path"], r["num_tokens"]) for r in made) == sorted((k, len(v) // 2) for k, v in want.items())


def test_export_leaves_shard_files_alone_on_the_disk(spark, tmp_path, monkeypatch):
    """Encoded ids go with the last turn, the exchanges of ids carry them packed."""
    session.shared_dir(spark)  # for checkpoints
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))  # other sessions may write to the common one
    assert QUERIES["export_bin"](spark, "/root/testdata/sf0.001").count() > 2
    assert {f.name.split("-")[0] for f in tmp_path.iterdir()} == {"bin", "turns"}
    docs = with_ids(docs_of(spark, [6, 6, 3])).withColumn("shard_idx", F.lit(0))
    plan = sf.export_bin(docs, str(tmp_path / "unused"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(mix_source") < plan.index("ArrowEvalPython")  # packed below the exchange


@pytest.mark.parametrize("seq_len,chunk", [(16, 50), (16, 7), (1, 5), (64, 1000), (10, 10)])
def test_only_ends_of_chunks_are_exchanged(spark, seq_len, chunk):
    rng = random.Random(seq_len + chunk)
    shards, chunks, lanes, streams = [], [], {}, {}
    for k in range(12):
        ids, lane = [rng.randint(0, 65_535) for _ in range(rng.randint(1, 130))], (("train", "val")[k % 2], 0, 0, k % 3)
        shards.append(("s", k, *lane, len(streams.setdefault(lane, []))))
        chunks += [("s", lane[0], k, at, ids[at:at + chunk]) for at in range(0, len(ids), chunk)]
        streams[lane] += ids
    chunks.append(("other", "train", 0, 0, [1] * 100))  # a file that no manifest lists
    want = {(*lane, i): ids[i * seq_len:(i + 1) * seq_len] for lane, ids in streams.items() for i in range(len(ids) // seq_len)}
    placed = spark.createDataFrame(shards, "source string, shard_idx int, split string, epoch int, rank int, worker int, stream_off long")
    table = spark.createDataFrame(chunks, "source string, split string, shard_idx int, start_tok long, ids array<int>").repartition(4)
    got = pack.pack_chunks(table, placed, seq_len)
    assert got.columns == ["split", "epoch", "rank", "worker", "seq_idx", "input_ids"]
    found = [(tuple(r)[:5], r["input_ids"]) for r in got.collect()]
    assert len(found) == len(want) and dict(found) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython", plan.index("hashpartitioning")) > plan.index("hashpartitioning")
    assert plan.index("Generate explode(sequence") < plan.index("hashpartitioning")  # whole sequences before any exchange


ENTRY = "path string, num_tokens long, shard_idx int, source string, split string"


def test_manifest_paths_fallback_and_guard(spark, tmp_path):
    rows = [("/abs/x_train_shard_0001.bin", 5, 1, "x", "train"), ("rel/x_train_shard_0000.bin", 7, 0, "x", "train")]
    entries = spark.createDataFrame(rows, ENTRY)
    sf.write_manifest(sf.manifest(entries, "t", 263, 10, 0.1), entries, str(tmp_path / "m"))
    head, listed = sf.read_manifest(spark, str(tmp_path / "m"))
    assert tuple(head.first()) == ("t", 263, 10, "uint16", 12, 0, 0.1)
    sf.manifest_document(head, listed).coalesce(1).write.json(str(tmp_path / "doc"))
    back = sf.resolved(sf.document_entries(sf.read_document(spark, str(tmp_path / "doc"))), "/base/")
    with pytest.raises(ValueError):
        sf.manifest_document(head, listed, most=1)
    assert {r["path"] for r in back.collect()} == {"/abs/x_train_shard_0001.bin", "/base/x_train_shard_0000.bin"}
    assert {r["split"] for r in sf.select_split(entries, "val").collect()} == {"train"}
    assert sf.require_shards(entries, "train").count() == 2
    with pytest.raises(sf.NoShardsError):
        sf.require_shards(entries, "val")
    again = sf.resync_manifest(entries.filter("false"), "t", 263).first()
    assert again["val_fraction"] == 0.0 and again["total_train_tokens"] == 0
    names = spark.createDataFrame([("my_src_val_shard_12345.bin",), ("a_test_shard_0001.bin",), ("a_train_shard_1.txt",)], "n string")
    got = [r[0] for r in names.select(sh.parse_shard_name(F.col("n"))).collect()]
    assert tuple(got[0]) == ("my_src", "val", 12345) and got[1:] == [None, None]


def test_drift_statuses(spark):
    listed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, num_tokens long")
    disk = spark.createDataFrame([("b", 2), ("c", 4), ("d", 5)], "name string, num_tokens long")
    got = {r["name"]: r["status"] for r in report.manifest_drift(listed, disk).collect()}
    assert got == {"a": "missing_on_disk", "b": "both", "c": "size_mismatch", "d": "not_in_manifest"}


def test_failing_and_empty_sources(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, text string").write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([], "id long, text string").write.parquet(str(tmp_path / "empty"))
    mix = Mixture((SourceSpec("bad", str(tmp_path / "none")), SourceSpec("good", str(tmp_path / "good")),
                   SourceSpec("cfg", str(tmp_path), config="good"), SourceSpec("empty", str(tmp_path / "empty"))))
    docs, failures = rd.read_mixture_isolated(spark, mix, {"cfg": ["other"]})
    assert sorted(r["mix_source"] for r in docs.collect()) == ["cfg", "good"]
    assert sorted(r["mix_source"] for r in failures.collect()) == ["bad", "cfg"]
    (tmp_path / "rows.json").write_text('{"id": 1, "text": "x"}\n{"id": broken\n')
    good, bad = rd.split_bad_records(spark, str(tmp_path / "rows.json"), "id long, text string")
    assert [tuple(r) for r in good.collect()] == [(1, "x")] and bad.count() == 1


def test_filters_and_columns_reach_the_scan(spark):
    df = rd.read_documents(spark, fx.mixture("/root/testdata/sf0.001").sources[1])
    plan = df._jdf.queryExecution().toString()
    assert "EqualTo(lang,fr)" in plan and "REPARTITION_BY_NUM" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan


def test_writers_of_one_manifest(spark, tmp_path):
    """Appends at the same time both survive; one that must follow a version raises; old versions stay as they were."""
    from concurrent.futures import ThreadPoolExecutor

    from shardloom.sources.manifest_log import ConflictError, ManifestLog

    def entry(i, split="train"):
        return spark.createDataFrame([(f"x_{split}_shard_{i:04d}.bin", 10 + i, i, "x", split)], ENTRY)

    log = ManifestLog(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        log.read()
    assert log.commit(entry(0), "t", 263, 10, after=-1) == 0
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda i: ManifestLog(spark, log.path).commit(entry(i), "t", 263, 10), range(1, 5)))
    assert sorted(made) == [1, 2, 3, 4] == log.versions()[1:]
    head, entries = log.read()
    assert sorted(r["shard_idx"] for r in entries.collect()) == [0, 1, 2, 3, 4] and head.first()["total_train_tokens"] == 60
    with pytest.raises(ConflictError):
        log.commit(entry(9), "t", 263, after=2)
    again = ManifestLog(spark, log.path)
    again.versions = lambda: [0, 1, 2, 3]  # as it was when another writer came first
    with pytest.raises(ConflictError):
        again.commit(entry(9), "t", 263, after=3)
    assert log.commit(entry(5, "val"), "t", 263, after=4) == 5
    assert sorted(r["shard_idx"] for r in log.read(0)[1].collect()) == [0] and log.read(4)[1].count() == 5
    assert {(r["shard_idx"], r["version"]) for r in log.added().collect()} >= {(0, 0), (5, 5)} and log.added().count() == 6

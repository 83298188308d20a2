"""Shard files as a data source, and the shard writer over a stream, against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from shardloom.operators import shards as sh
from shardloom.operators.split import budget_cut
from shardloom.sources import shard_files as sf
from shardloom.sources import shard_source as src
from shardloom.streaming import jobs
from shardloom.streaming.shard_writer import ROWS, ShardWriter

SIZE = 50


def documents(n, seed):
    rng = random.Random(seed)
    return [(s, k, i, "val" if rng.random() < 0.2 else "train", length, [(i * 31 + j) % 60_000 for j in range(length)])
            for k, s in enumerate(("a", "b")) for i in range(n) for length in [rng.choice([1, 3, 20, 49, 50, 130])]]


def batch_shards(spark, rows, budgets=None):
    df = spark.createDataFrame(rows, ROWS)
    thin = df.drop("ids") if budgets is None else budget_cut(df.drop("ids"), budgets)
    return {(r["mix_source"], r["split"], r["shard"]): (r["num_tokens"], r["n_docs"], r["min_ord"], r["max_ord"])
            for r in sh.shard_totals(sh.shards_greedy(thin, SIZE)).collect()}


def streamed(writer):
    return {(r["mix_source"], r["split"], r["shard"]): (r["num_tokens"], r["n_docs"], r["min_ord"], r["max_ord"]) for r in writer.closed().collect()}


def tokens_of(spark, writer, rows):
    """What the files of each shard hold, and what it should be."""
    held, want = {}, {}
    for r in sf.read_bin(spark, f"{writer.out}/shards", chunk=7).collect():
        held.setdefault(r["shard_idx"], {})[r["start_tok"]] = r["ids"]
    for r in writer.closed().collect():
        want[r["shard_idx"]] = [t for s, _, i, p, _, ids in rows if (s, p) == (r["mix_source"], r["split"]) and r["min_ord"] <= i <= r["max_ord"] for t in ids]
    return {k: [t for at in sorted(v) for t in v[at]] for k, v in held.items()}, want


@pytest.mark.parametrize("cuts", [(), (1, 2, 30), (13, 14, 39)])
def test_any_cut_gives_the_shards_of_the_batch(spark, tmp_path, cuts):
    rows = documents(40, 1)
    budgets = spark.createDataFrame([("a", 900), ("b", None)], "mix_source string, budget long")
    writer = ShardWriter(spark, str(tmp_path / "out"), SIZE, "t", 263, budgets)
    for k, (low, high) in enumerate(zip((0, *cuts), (*cuts, 99))):
        batch = spark.createDataFrame([r for r in rows if low <= r[2] < high], ROWS)
        writer.apply(batch, k)
        if k % 2:
            writer.apply(batch, k)  # a batch that is run again changes nothing
    writer.finish()
    assert streamed(writer) == batch_shards(spark, rows, budgets)
    held, want = tokens_of(spark, writer, rows)
    assert held == want and sorted(held) == list(range(len(held)))
    entries = sf.read_manifest(spark, f"{writer.out}/manifest")[1].collect()
    assert sorted(r["shard_idx"] for r in entries) == sorted(held)


def test_a_stream_that_stops_goes_on(spark, tmp_path):
    rows = documents(30, 2)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    writer = ShardWriter(spark, out, SIZE, "t", 263)
    stream = lambda: jobs.file_stream(spark, landing, spark.createDataFrame([], ROWS).schema, files_per_trigger=1)
    for low, high in ((0, 7), (7, 8), (8, 30)):
        spark.createDataFrame([r for r in rows if low <= r[2] < high], ROWS).coalesce(1).write.mode("append").parquet(landing)
        if high != 8:
            writer.follow(stream(), str(tmp_path / "state"))
    assert sum(r["n_docs"] for r in writer.closed().collect()) < len(rows)
    ShardWriter(spark, out, SIZE, "t", 263).finish()
    assert streamed(writer) == batch_shards(spark, rows)
    with pytest.raises(ValueError, match="left no state"):
        writer.apply(spark.createDataFrame([], ROWS), 99)


def test_ranges_of_a_large_file(tmp_path):
    """A sparse file of 4.2 GB is planned in ranges; the last one is read without what lies before it."""
    path = tmp_path / "a_train_shard_0000.bin"
    with path.open("wb") as f:
        f.seek(4_200_000_000 - 4)
        f.write(b"\x01\x00\x02\x00")
    (tmp_path / "a_val_shard_0001.bin").write_bytes(b"\x05\x00")
    reader = src.ShardReader({"path": f"file://{tmp_path}", "split": "train"})
    parts = reader.partitions()
    assert {p.split for p in parts} == {"train"} and parts[-1].end == 2_100_000_000
    assert all(p.end - p.start <= src.READ_CHUNK * src.RANGE_CHUNKS for p in parts) and [p.end for p in parts[:-1]] == [p.start for p in parts[1:]]
    last = [b for b in reader.read(parts[-1])]
    assert max(b.num_rows for b in last) == 1 and last[-1].column(4)[0].as_py()[-2:] == [1, 2]


def test_small_files_share_partitions(spark, tmp_path):
    """Tasks follow the bytes: thousands of small files are a few partitions, and every file is read once and whole."""
    for i in range(3000):
        (tmp_path / f"a_train_shard_{i:04d}.bin").write_bytes(bytes([i % 251, i // 251]) * (i % 40 + 1))
    rows = sf.read_bin(spark, str(tmp_path), chunk=16)
    assert rows.rdd.getNumPartitions() <= 8
    got = {}
    for r in rows.orderBy("shard_idx", "start_tok").collect():
        assert r["start_tok"] == len(got.setdefault(r["shard_idx"], [])) and len(r["ids"]) <= 16
        got[r["shard_idx"]] += r["ids"]
    assert got == {i: [i % 251 + 256 * (i // 251)] * (i % 40 + 1) for i in range(3000)}
    sizes = [src.ShardRange("p", "a", "train", i, 0, n) for i, n in enumerate((5, 5, 11, 1, 9, 1))]
    assert [[r.shard_idx, *[x.shard_idx for x in r.more]] for r in src.shared(sizes, 10)] == [[0, 1], [2], [3, 4], [5]]


def test_other_splits_are_not_opened(spark, tmp_path, request):
    (tmp_path / "a_train_shard_0000.bin").write_bytes(b"\x07\x00\x08\x00")
    (tmp_path / "b_val_shard_0001.bin").write_bytes(b"\x05\x00")
    got = sf.read_bin(spark, str(tmp_path), split="val").collect()
    assert [(r["source"], r["ids"]) for r in got] == [("b", [5])]
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    request.addfinalizer(lambda: spark.conf.unset(key))
    (tmp_path / "b_val_shard_0001.bin").chmod(0)
    rows = sf.read_bin(spark, str(tmp_path)).filter((F.col("split") == "train") & (F.col("shard_idx") == 0) & (F.col("start_tok") == 0))
    assert [r["ids"] for r in rows.collect()] == [[7, 8]]
    assert rows.rdd.getNumPartitions() == 1
    assert sf.read_bin(spark, str(tmp_path)).filter("shard_idx in (5, 6)").count() == 0

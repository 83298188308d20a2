import math
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from shardloom.operators import metrics as me
from shardloom.operators import ngram
from shardloom.operators.report import eta_seconds
from shardloom.streaming import jobs

STEP = "run_id string, step long, loss double, grad_norm double"


def series(spark, **runs):
    return spark.createDataFrame([(r, i, float(v), 1.0) for r, vs in runs.items() for i, v in enumerate(vs)], STEP)


def test_health(spark):
    falling = [10 - i * 0.05 for i in range(150)]
    df = series(spark, falling=falling, flat=[5.0] * 150, zero=falling[:60] + [0.0] * 90, low=[0.05] + falling[1:])
    got = {r["run_id"]: r for r in me.run_health(df, 32768).collect()}
    assert got["falling"]["healthy"] and not got["flat"]["healthy"] and not got["flat"]["loss_falls"]
    assert got["zero"]["zero_loss"] and not got["zero"]["healthy"] and not got["low"]["starts_high"]


def test_loss_and_perplexity(spark):
    df = spark.createDataFrame([(1.0, 1), (4.0, 3)], "loss double, tokens long")
    assert df.select(me.weighted_loss()).first()[0] == 3.25
    assert df.filter("false").select(me.weighted_loss()).first()[0] == math.inf
    row = spark.createDataFrame([(25.0,)], "x double").select(
        me.perplexity_capped(F.col("x")), me.perplexity_or_inf(F.col("x"))).first()
    assert row[0] == math.exp(20) and row[1] == math.inf


def test_peaks_and_utilisation(spark):
    names = ["NVIDIA H100", "a100", "RTX 4090", "RTX 4080", "RTX 3090", "RTX A6000", "unknown"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(me.peak_tflops(F.col("n"))).collect()] == [989.0, 312.0, 82.6, 48.7, 35.6, 38.7, 82.6]
    zero = df.select(me.mfu_percent(F.lit(10.0), F.lit(5.0), F.lit(0.0))).first()[0]
    assert zero == 0.0
    assert me.flops_per_token(1280, 13, 3456) == 13 * (6 * 1280**2 + 6 * 1280 * 3456)


def test_retention_keeps_few_when_space_is_short(spark):
    rows = [("r", f"x/checkpoint_step_{i:07d}.pt") for i in range(6)] + [("r", "x/checkpoint_best.pt"), ("r", "x/notes.txt")]
    df = spark.createDataFrame(rows, "run_id string, path string")
    steps = lambda gb: sorted(r["step"] for r in me.retention_plan(df, 3, gb).collect())
    assert steps(100.0) == [0, 1, 2] and steps(4.0) == [0, 1, 2, 3] and steps(0.5) == [0, 1, 2, 3, 4]


def test_nucleus_keeps_ties_and_the_first(spark):
    rows = [(0, 1, 2.0), (0, 2, 1.0), (0, 3, 1.0), (0, 4, 0.5), (1, 9, 5.0)]
    df = spark.createDataFrame(rows, "context int, token int, score double")
    kept = ngram.topk_nucleus(df, 2, None).collect()
    assert sorted(r["token"] for r in kept) == [1, 2, 3, 9]
    assert sorted(r["token"] for r in ngram.topk_nucleus(df, None, 0.0).collect()) == [1, 9]
    total = ngram.topk_nucleus(df, 3, 0.9).groupBy("context").agg(F.sum("prob").alias("p")).collect()
    assert all(abs(r["p"] - 1) < 1e-12 for r in total)


def test_sampling_follows_the_weights(spark):
    df = spark.range(4000).select(F.col("id").cast("int").alias("context"), F.explode(F.array(
        F.struct(F.lit(1).alias("token"), F.lit(0.8).alias("prob")), F.struct(F.lit(2).alias("token"), F.lit(0.2).alias("prob")))).alias("s")).select("context", "s.*")
    n = ngram.sample_next(df, 3).filter("token = 1").count()
    assert 3050 < n < 3350


def test_eta(spark):
    df = spark.createDataFrame([(100, 50, 10.0), (100, 0, 10.0)], "r long, t long, e double")
    assert [x[0] for x in df.select(eta_seconds(F.col("r"), F.col("t"), F.col("e"))).collect()] == [20.0, None]


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    part = lambda a, b: spark.range(a, b).select("id", (F.col("id") % 7 + 3).alias("n_tokens"))
    schema = part(0, 1).schema
    part(0, 40).coalesce(1).write.parquet(src)
    jobs.run_to_table(jobs.file_stream(spark, src, schema, files_per_trigger=1), out, state)
    part(40, 90).coalesce(1).write.mode("append").parquet(src)
    jobs.run_to_table(jobs.file_stream(spark, src, schema, files_per_trigger=1), out, state)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, part(0, 90).collect()))
    seen = jobs.observed_ingest(jobs.file_stream(spark, src, schema), str(tmp_path / "o2"), str(tmp_path / "s2"))
    assert sum(p["n_samples"] for p in seen) == 90


def test_manifest_follows_arriving_shards(spark, tmp_path):
    from shardloom.sources.shard_files import read_manifest

    src, man, state = (str(tmp_path / n) for n in ("in", "man", "state"))
    schema = "path string, num_tokens long, shard_idx int, source string, split string"
    for i in range(3):
        spark.createDataFrame([(f"a_train_shard_{i:04d}.bin", 10 + i, i, "a", "train")], schema).coalesce(1).write.mode("append").parquet(src)
        jobs.follow_manifest(jobs.file_stream(spark, src, schema, files_per_trigger=1), man, state, "t", 263)
        head, entries = read_manifest(spark, man)
        assert entries.count() == i + 1 and head.first()["shard_size"] == 10 + i and head.first()["total_train_tokens"] == sum(range(10, 11 + i))


def test_late_points_are_dropped(spark, tmp_path):
    src = str(tmp_path / "pts")
    schema = "ts timestamp, tag string, value double"
    batch = lambda rows: spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"(timestamp'{t}', 'a', {v}D)" for t, v in rows) + " AS t(ts, tag, value)").coalesce(1).write.mode("append").parquet(src)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for rows in ([("2024-01-01 01:00:00", 1), ("2024-01-03 00:00:00", 2)], [("2024-01-01 02:00:00", 100), ("2024-01-05 00:00:00", 3)]):
        batch(rows)
        jobs.run_to_table(jobs.windowed_metrics(jobs.file_stream(spark, src, schema)), out, state)
    got = {str(r["start"])[:10]: r["total"] for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-03": 2.0}


class FakeState:
    def __init__(self):
        self.exists, self.hasTimedOut, self.get, self.delay = False, False, None, None

    def update(self, v):
        self.exists, self.get = True, v

    def setTimeoutDuration(self, ms):
        self.delay = ms

    def remove(self):
        self.exists = False


def test_best_so_far_and_stall():
    state = FakeState()
    points = pd.DataFrame({"run_id": ["r"] * 3, "step": [1, 2, 3], "value": [5.0, 3.0, 3.0]})
    out = next(jobs._advance(("r",), jobs._briefs(iter([points])), state))
    assert out.iloc[0].tolist() == ["r", 3.0, 2, 3, False] and state.delay == 300_000
    worse = pd.DataFrame({"run_id": ["r"], "step": [4], "value": [3.0]})
    assert next(jobs._advance(("r",), jobs._briefs(iter([worse])), state)).iloc[0].tolist() == ["r", 3.0, 2, 4, False]
    state.hasTimedOut = True
    assert next(jobs._advance(("r",), iter([]), state)).iloc[0].tolist() == ["r", 3.0, 2, 4, True]
    assert not state.exists


def test_a_silent_run_is_told_once(spark, tmp_path):
    """Over batches and restarts: gaps inside a batch and between batches, a run silent at the end, one that comes back."""
    from shardloom.streaming.stalls import run_stalls, stalls

    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "run_id string, step long, value double, ts timestamp"
    at = lambda h: f"2024-01-01 00:00:00' + INTERVAL {h} HOUR"
    batch = lambda rows: spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('{r}', {s}L, {v}D, timestamp'{at(h)})" for r, s, v, h in rows) + " AS t(run_id, step, value, ts)").coalesce(1).write.mode("append").parquet(src)
    parts = [[("a", 1, 5, 0), ("b", 1, 9, 1), ("a", 2, 3, 2), ("a", 3, 4, 20)], [("b", 2, 8, 21), ("a", 4, 1, 22)],
             [("c", 1, 1, 40), ("b", 3, 8, 41)], [("c", 2, 1, 44), ("b", 4, 9, 45)]]
    for rows in parts:
        batch(rows)
        run_stalls(stalls(spark.readStream.schema(schema).parquet(src), 10 * 3600), out, state)
    got = sorted((r["run_id"], r["last_ts"].hour + 24 * (r["last_ts"].day - 1), r["best"], r["best_step"], r["n_seen"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2, 3.0, 2, 2), ("a", 22, 1.0, 4, 4), ("b", 1, 9.0, 1, 1), ("b", 21, 8.0, 2, 2)]


def test_pairs_are_counted_where_they_lie(spark, monkeypatch):
    """Every group and width of ids against plain counting; a token is never a row of its own."""
    rows = [(g, [(i * i + k) % (7 if g else 60_000) for k in range(i % 9)]) for i in range(200) for g in ("a", "b", None, "")]
    docs = spark.createDataFrame(rows, "g string, ids array<int>").repartition(3)
    want = Counter((g, a, b) for g, ids in rows for a, b in zip(ids, ids[1:]))
    for cells, step in ((1 << 22, 1 << 20), (300, 5), (0, 1)):
        monkeypatch.setattr(ngram, "CELLS", cells)
        monkeypatch.setattr(ngram, "COUNTED", step)
        got = ngram.bigram_counts(docs, ["g"])
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert {(r["g"], r["prev"], r["next"]): r["n"] for r in got.collect()} == want
    alone = {(r["prev"], r["next"]): r["n"] for r in ngram.bigram_counts(docs, []).collect()}
    assert alone == Counter((a, b) for _, ids in rows for a, b in zip(ids, ids[1:]))
    assert ngram.bigram_counts(docs.filter("size(ids) < 2"), ["g"]).count() == 0

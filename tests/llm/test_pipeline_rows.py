"""What the pipeline's stages decide, row by row."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from shardloom.llm import common
from shardloom.llm import shingle_dedup as sd
from tests.llm import brute

STAGE = dict(cp.STAGES)


def shingles(text):
    w = brute.blank_words(text)
    return frozenset(" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def alike_pairs(sets):
    """All pairs at 0.8 or more that share a shingle."""
    at = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            at[x].append(k)
    met = {(a, b) for v in at.values() for i, a in enumerate(v) for b in v[i + 1:]}
    return {(a, b) for a, b in met if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}


def survivors(rows):
    """Ids that stay: the smallest of every group of similar texts, null last."""
    sets, top = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in alike_pairs(sets):
        top[root(a)] = root(b)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[root(k)].append(i)
    return sorted((min(g, key=lambda i: (i is None, i or 0)) for g in groups.values()), key=repr)


def test_near_stage_finds_similar_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(1000)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = STAGE["SimHash near-dedup"](spark, docs, "").select("doc_id").collect()
    assert sorted((r[0] for r in got), key=repr) == survivors(rows)
    odd = brute.odd_documents(spark)
    got = STAGE["SimHash near-dedup"](spark, odd, "").select("doc_id").collect()
    assert sorted((r[0] for r in got), key=repr) == survivors([tuple(r) for r in odd.select("doc_id", "text").collect()])


def test_recall_of_fingerprints_at_the_limit():
    rng, met = np.random.default_rng(1), 0
    for _ in range(400):
        h = rng.integers(0, 1 << 63, 360, np.uint64)
        a, b = np.sort(h[:320]), np.sort(np.concatenate([h[:40 * 7], h[320:]]))[:]
        x, y = sd.min_fingerprints(a), sd.min_fingerprints(b)
        assert abs(len(np.intersect1d(a, b)) / len(np.union1d(a, b)) - 0.777) < 0.001
        met += bool((np.bitwise_count(x ^ y) <= sd.RADIUS).any())
    assert met >= 0.97 * 400


def test_rows_of_one_id_are_judged_one_by_one(spark):
    """A good row does not keep rejected, repeated or contaminated rows of its id, or of no id."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = cp.quality_scores(docs, cp.fit_quality(docs, cp.table(spark, sf, "labels").filter(~cp.in_fold(F.col("doc_id"), 0))))
    low = {r["doc_id"] for r in scored.filter(F.col("score") < cp.THRESHOLD).collect()}
    nameless = docs.select(*[F.lit(None).cast("long").alias(c) if c == "doc_id" else c for c in docs.columns])
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert low
    got = STAGE["quality classifier"](spark, docs.union(nameless), sf).select("doc_id", "text").collect()
    want = [(i, t) for i, t in text.items() if i not in low]
    assert brute.in_order(map(tuple, got)) == brute.in_order(want + [(None, t) for _, t in want])

    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    rows = spark.createDataFrame([(None, "fine words of its own", "en", "s", 1), (None, item, "en", "s", 1), (3, item, "en", "s", 1),
                                  (3, "other fine words", "en", "s", 1)], brute.SCHEMA)
    got = STAGE["benchmark decontamination"](spark, rows, sf).select("doc_id", "text").collect()
    assert brute.in_order(map(tuple, got)) == brute.in_order([(None, "fine words of its own"), (3, "other fine words")])

    copies = spark.createDataFrame([(3, "one text of some words here", "en", "s", 1)] * 2
                                   + [(None, "a text without any id at all", "en", "s", 1)] * 2, brute.SCHEMA)
    once = STAGE["SimHash near-dedup"](spark, STAGE["exact dedup"](spark, copies, sf), sf).select("doc_id").collect()
    assert brute.in_order(map(tuple, once)) == brute.in_order([(3,), (None,)])


def test_shingles_in_slices(monkeypatch):
    text = " \t".join(f"w{i % 97} x{i}" for i in range(3000)).encode()
    whole = sd.shingle_hashes(text)
    for size in (1, 10, 333):
        monkeypatch.setattr(sd, "SLICE", size)
        assert (sd.shingle_hashes(text) == whole).all() and len(whole) == len(shingles(text.decode()))
        for few in (b"", b" \n", b"a", b" a b\x0bc d ", b"a b c d e"):
            assert len(sd.shingle_hashes(few)) == 1
        assert (sd.shingle_hashes(b" a b") == sd.shingle_hashes(b"a\rb ")).all()


def test_batches_are_bounded_in_bytes(spark):
    """A table of long texts reaches a worker in batches of few bytes; a smaller limit of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    try:
        common.bound_batches(spark)
        assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) <= common.BATCH_BYTES + 2_000_000
        spark.conf.set(key, "1000000")
        common.bound_batches(spark)
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.set(key, before)


def test_no_pair_of_texts_is_compared_twice(spark, monkeypatch):
    """Texts that are close but not close enough meet in many tables; each pair of them is compared once."""
    rng = np.random.default_rng(3)
    base, rows = [f"w{k}" for k in range(400)], []
    for i in range(40):
        own = list(base)
        for at in rng.choice(400, 8, replace=False):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own)))
    assert not alike_pairs([shingles(t) for _, t in rows])
    compared, real = [], sd._verified

    def seen(pairs, texts):
        compared.extend((r["a"], r["b"]) for r in pairs.collect())
        return real(pairs, texts)

    monkeypatch.setattr(sd, "_verified", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sd.similar_rows(common.with_row_key(docs)).filter("keep").count() == 40
    assert len(compared) > 40 and len(set(compared)) == len(compared)

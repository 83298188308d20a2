"""Resampling, top-k search and clustering against plain re-computation: odd rows, ties, layouts, bounds."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import centroids as ce
from shardloom.llm import resample as rs
from shardloom.llm import topk
from tests.llm import brute

VECTORS = "vec_id long, embedding array<double>, label int"


def runs(text):
    w = brute.letter_words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def buckets(texts):
    return Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in runs(t)[0])


def resampled(rows, target, percent, least):
    s, t = buckets(x for _, x in rows), buckets(target)
    sn, tn = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sn + 10_000) / ((s[b] + 1) * (tn + 10_000)))) for b in s}
    out = []
    for i, x in rows:
        f, n = runs(x)
        h = int(brute.sha(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain[zlib.crc32(g.encode()) % 10_000] for g in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in out]


def test_resample_odd_rows(spark):
    odd = brute.odd_documents(spark)
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    target = spark.createDataFrame([(1, "some words in it"), (2, None), (None, "lorem ipsum, Ünïcödé"), (4, "")], "item_id long, text string")
    texts = [r["text"] for r in target.collect()]
    for percent, least in ((50, 1), (100, 3), (5, 20), (0, 1)):
        want = brute.in_order(resampled(rows, texts, percent, least))
        for table in (odd.repartition(5), brute.with_clashes(odd.repartition(1))):
            got = rs.resample(table, target, percent=percent, least_words=least)
            assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
            assert brute.in_order(map(tuple, got.collect())) == want


def test_resample_empty(spark):
    none, odd = spark.createDataFrame([], brute.SCHEMA), brute.odd_documents(spark)
    assert rs.resample(none, odd).count() == 0
    assert rs.resample(odd, none).count() == odd.count()


def test_words_in_slices(monkeypatch):
    text = ("Alpha beta-GAMMA  délta 42, x " * 300).encode()
    whole = rs.bucket_counts(memoryview(text))
    for size in (1, 7, 100):
        monkeypatch.setattr(rs, "SLICE", size)
        counts, n = rs.bucket_counts(memoryview(text))
        assert n == whole[1] == 1800 and (counts == whole[0]).all()
    assert Counter({b: int(n) for b, n in enumerate(whole[0]) if n}) == buckets([text.decode()])


def test_planes_add_up():
    rng = np.random.default_rng(3)
    for top in (1, 2, 1000, 10 ** 7):
        counts, gain = rng.integers(0, top + 1, 10_000), rng.integers(-20_000, 20_000, 10_000)
        assert rs.weigh(counts, *rs.signed_planes(gain)) == int(counts @ gain)
    assert rs.weigh(np.zeros(10_000, np.int64), *rs.signed_planes(np.zeros(10_000, np.int64))) == 0


def odd_vectors(dim, extra=()):
    rng = np.random.default_rng(dim)
    fine = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(0, 0.3, (70, dim)))]
    one = fine[5][1]
    return fine + [(200 + i, one, None) for i in range(40)] + [(20, one, 1), (20, one, 1), (None, one, 1), (None, fine[9][1], 1),
        (300, None, 1), (400, [], 1), (500, [None] + one[1:], 1), (600, [float("nan")] + one[1:], 1), (700, [float("inf")] + one[1:], 1),
        (800, one[1:], 1), (820, [0.0] * dim, 1), (840, [-0.0] * dim, 1), (860, [50.0] * dim, 1)] + list(extra)


def whole(v, scale):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def best(rows, k):
    vs = [(i, whole(v, 64)) for i, v, _ in rows]
    vs = [(i, v) for i, v in vs if v is not None]
    out = []
    for a, (i, v) in enumerate(vs):
        if i is not None and i % 20 == 0:
            found = sorted(((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, j) for b, (j, w) in enumerate(vs) if a != b and len(v) == len(w)))
            out += [(i, n, f[3], -f[0]) for n, f in enumerate(found[:k], 1)]
    return brute.in_order(out)


@pytest.mark.parametrize("k", [1, 20, 500])
def test_topk_odd_rows(spark, monkeypatch, k):
    rows = odd_vectors(24)
    table = spark.createDataFrame(rows, VECTORS)
    want = best(rows, k)
    asks = F.col("vec_id") % 20 == 0
    got = topk.top_products(table.repartition(3), asks, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert brute.in_order(map(tuple, got.collect())) == want
    monkeypatch.setattr(topk, "CELL_QUERIES", 3)
    monkeypatch.setattr(topk, "CELL_CANDIDATES", 40)
    assert brute.in_order(map(tuple, topk.top_products(brute.with_clashes(table, {"vec_id"}), asks, k).collect())) == want
    assert topk.top_products(table.filter("false"), asks).count() == 0
    assert topk.top_products(table.filter("vec_id % 20 != 0"), asks).count() == 0


@pytest.mark.parametrize("sparse", [0.0, 0.05, 1.0])
def test_search_by_tiles(monkeypatch, sparse):
    monkeypatch.setattr(topk, "SPARSE", sparse)
    monkeypatch.setattr(topk, "TILE_QUERIES", 7)
    monkeypatch.setattr(topk, "TILE_CANDIDATES", 50)
    rng = np.random.default_rng(1)
    for scale, dims in ((5, 30), (2 ** 27, 3), (1, 1)):
        c = rng.integers(-scale, scale, (400, dims)) * rng.integers(0, 3, (400, 1))
        rows = np.arange(400)
        q, s, order = c[:30], c[:30] @ c.T, rng.permutation(400)
        qi, ci, got = topk.search(q, rows[:30], c, rows, order, 20)
        for a in range(30):
            want = sorted(((-s[a, b], order[b]) for b in range(400) if a != b))[:20]
            assert sorted((-x, order[b]) for b, x in zip(ci[qi == a], got[qi == a])) == want


def clustered(rows, dim, k, rounds):
    vs = [(i, whole(v, 256)) for i, v, _ in rows if v is not None and len(v) == dim]
    vs = [(i, v) for i, v in vs if v is not None]
    cs = [v for _, v in sorted(((brute.sha(f"2:{'' if i is None else i}"), v) for i, v in vs))[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(cs)) for _, v in vs]

    for _ in range(rounds):
        at = assign()
        for n in range(len(cs)):
            own = [v for (_, v), (_, m) in zip(vs, at) if m == n]
            if own:
                cs[n] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    inertia = Counter()
    for d, n in at:
        inertia[n] += d
    return [(i, n, d, inertia[n], sum(inertia.values()), brute.sha(",".join(map(str, cs[n])))) for (i, _), (d, n) in zip(vs, at)]


@pytest.mark.parametrize("k", [1, 7, 40, 500])
def test_clusters_odd_rows(spark, k):
    rows = odd_vectors(12)
    table = spark.createDataFrame(rows, VECTORS)
    want = brute.in_order(clustered(rows, 12, k, 3))
    for t in (table.repartition(4), brute.with_clashes(table.repartition(1), {"vec_id"})):
        got = ce.clusters(t, k, 3, dim=12)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert brute.in_order(map(tuple, got.collect())) == want
    assert ce.clusters(table).count() == 0 and ce.clusters(table.filter("false")).columns == got.columns


def test_pivot_bounds_hold_and_prune():
    rng = np.random.default_rng(7)
    hubs = rng.integers(-3000, 3000, (40, 64))
    v = hubs[rng.integers(0, 40, 3000)] + rng.integers(-200, 200, (3000, 64))
    pivots = ce.choose_pivots(hubs)
    dx, dc, between = ce.pivot_distances(v, pivots), ce.pivot_distances(hubs, pivots), ce.pivot_distances(pivots, pivots)
    exact = np.array([ce.squared(v, c) for c in hubs]).T
    bound = ce.lower_bounds(dx, dc, between)
    assert (bound <= exact).all()
    at, best_d = ce.nearest(v, dx, hubs, dc, between)
    assert (at == exact.argmin(axis=1)).all() and (best_d == exact.min(axis=1)).all()
    assert (bound > best_d[:, None]).mean() > 0.5  # most of these separate hubs are never looked at
    with pytest.raises(Exception, match="do not fit"):
        next(iter(ce._with_pivots(np.zeros((1, 2), np.int64))(iter([_batch([[1 << 28, 0]])]))))


def _batch(v):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([0]), pa.array(v, pa.list_(pa.int64()))], names=["vec_id", "v"])


def test_digest_of_a_centroid():
    assert ce.digest(np.array([1, -2, 3])) == hashlib.sha256(b"1,-2,3").hexdigest()

"""The compression classifier: held-out accuracy, bounds of the fit, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from shardloom.llm import queries as q
from shardloom.llm.common import in_fold
from shardloom.llm.quality import BLOCK, blocks_of, build_dictionary, calibrate, expanded, fit_quality, quality_scores
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_blocks_cover_the_whole_text():
    for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, BLOCK * 3 // 2, BLOCK * 3 // 2 + 1, 7 * BLOCK + 5):
        text = bytes(i % 251 for i in range(n))
        assert b"".join(blocks_of(text)) == text and (n == 0 or all(blocks_of(text)))


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = q.op1_quality_classifier(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    y, s = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    above = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert above > 0.85 and all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9


def test_every_row_once_and_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["held_out"] for r in q.op1_quality_classifier(spark, SF).collect()}
    assert got == {r["doc_id"]: brute.in_fold(r["doc_id"], 0) for r in docs.select("doc_id").collect()}


def test_held_out_labels_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(in_fold(F.col("doc_id"), 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    known = lambda t: fit_quality(docs, t.filter(~in_fold(F.col("doc_id"), 0)))
    assert known(labels) == known(flipped)


def test_odd_rows_and_labels(spark):
    odd = brute.odd_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (1, 2, 4, 5, 6, 7, 9, 10, 11, 12)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (8, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    model = fit_quality(odd, labels)
    rows = quality_scores(brute.with_clashes(odd), model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    scores = {}
    for r in rows:
        scores.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(scores[3]) == 1 and scores[4] == scores[5]  # repeated rows alike; null like empty
    none = labels.filter("false")
    flat = {r["score"] for r in quality_scores(odd, fit_quality(odd, none)).collect()}
    assert len(flat) == 1 and abs(flat.pop() - 0.5) < 1e-9
    one_sided = {r["score"] for r in quality_scores(odd, fit_quality(odd, labels.filter("quality = 1"))).collect()}
    assert len(one_sided) == 1 and one_sided.pop() > 0.5
    assert quality_scores(odd.filter("false"), model).count() == 0


def test_dictionary_of_few_samples_and_calibration():
    assert build_dictionary([b"abc"]) == b"abc"
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.7).astype(float)
    f = np.column_stack([y + rng.normal(0, 1, 4000), rng.normal(0, 1, 4000), rng.normal(5, 1, 4000)])
    mean, scale, w = calibrate(f, y, np.ones(4000))
    p = 1 / (1 + np.exp(-expanded((f - mean) / scale) @ np.array(w)))
    for low in np.arange(0.1, 0.9, 0.2):
        some = (p >= low) & (p < low + 0.2)
        assert abs(p[some].mean() - y[some].mean()) < 0.06

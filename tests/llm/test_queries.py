"""Registered queries against their SQL, and the pipeline stage by stage against plain re-computation."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from shardloom.llm.queries import ORACLE, QUERIES
from shardloom.session import as_written
from tests.llm import brute
from tests.llm.test_pipeline_rows import survivors
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in queries()) == 1 for n in names) and "pipeline" in queries()
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(oracle_sql())
    assert len(cp.STAGES) == 5


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_sql(spark, key):
    assert compare(QUERIES[key](spark, SF), duck(SF), ORACLE[key]) is None


def ordered(values):
    return sorted(values, key=repr)


def ids(df):
    return ordered(r[0] for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stage = docs.columns, dict(cp.STAGES)
    low = {r["doc_id"] for r in QUERIES["op1_quality_classifier"](spark, SF).filter("predicted = 0").collect()}
    kept = as_written(stage["quality classifier"](spark, docs, SF), "one")
    assert kept.columns == columns and ids(kept) == ordered(set(ids(docs)) - low)

    rows = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    once = as_written(stage["exact dedup"](spark, kept, SF), "two")
    assert once.columns == columns and ids(once) == ordered(r[0] for r in brute.duplicates(rows) if r[3])

    rows = [tuple(r) for r in once.select("doc_id", "text").collect()]
    apart = as_written(stage["SimHash near-dedup"](spark, once, SF), "three")
    assert apart.columns == columns and ids(apart) == ordered(survivors(rows))

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [tuple(r) for r in apart.select("doc_id", "text").collect()]
    clean = as_written(stage["benchmark decontamination"](spark, apart, SF), "four")
    assert clean.columns == columns and ids(clean) == ordered(r[0] for r in brute.contamination(rows, items) if not r[5])

    mixed = stage["mixing sources to target weights"](spark, clean, SF)
    assert ids(mixed) == ids(clean)
    assert abs(mixed.agg(F.sum("taken") / F.sum("size")).first()[0] - 1.5) < 0.1
    assert sorted(map(tuple, cp.run(spark, SF).select("doc_id", "taken").collect())) == sorted(map(tuple, mixed.select("doc_id", "taken").collect()))


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_odd_and_empty_tables(spark, name):
    stage, odd = dict(cp.STAGES)[name], brute.odd_documents(spark)
    out = stage(spark, odd, SF).collect()
    assert len(out) <= odd.count() and {r["doc_id"] for r in out} <= {r["doc_id"] for r in odd.collect()}
    assert stage(spark, odd.filter("false"), SF).count() == 0


def test_odd_rows_of_the_filters(spark):
    odd, stage = brute.odd_documents(spark), dict(cp.STAGES)
    once = stage["exact dedup"](spark, odd, SF)
    # Of copies the largest id, and of rows of one id and text one row; a row without id goes if another has the text.
    assert ids(once) == ordered([3, 5, 6, None, 7, 8, 9, 10, 11, 12, 13, 13])
    assert ids(stage["benchmark decontamination"](spark, odd, SF)) == ids(odd)

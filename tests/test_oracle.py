"""Every registered query against its SQL, over whole tables."""

import pytest

from __spark_entry__ import entry
from shardloom.plans.oracle import ORACLE
from shardloom.plans.queries import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    # The whole vocabulary takes SQL hours; test_vocab checks that query against a plain trainer.
    assert set(QUERIES) - set(ORACLE) == {"bpe_vocabulary"} and set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query(spark, con, key):
    assert compare(QUERIES[key](spark, SF), con, ORACLE[key]) is None

"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from prefloom.registry.oracle import ORACLE
from prefloom.registry.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == ""


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 1
    assert df.columns[0] == "total_items"


def test_judge_stats_at_one_hundredth(spark):
    row = QUERIES["judge_stats"](spark, "/root/testdata/sf0.01").first()
    assert tuple(row) == (536, 488, 48, 91.04, 6.74, 10.0, 1.0, 7.0, 7.2058, 2.6844)

"""Queries that SQL can express, against that SQL, on whole tables."""

import pytest

from compare import connect, differences
from prefloom.llm.oracle import ORACLE
from prefloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) == ""

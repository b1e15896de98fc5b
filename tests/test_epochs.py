"""The seeded order of an epoch, against a plain version; the same on any partitioning."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from prefloom.operators import training
from conftest import rows


def plain_version(x, n, epoch, seed):
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for turn in range(training.ROUNDS):
            def number(v):
                return int(hashlib.md5(f"{seed}:{epoch}:{turn}:{v}".encode()).hexdigest()[:15], 16)
            if turn % 2 == 0:
                left = (left + number(right)) % a
            else:
                right = (right + number(left)) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 997])
def test_a_permutation_for_every_size(spark, n):
    df = spark.range(n).select(F.col("id").alias("pos"))
    for epoch, seed in ((0, 42), (3, 7)):
        got = [r[0] for r in df.select(training.permuted(F.col("pos"), n, F.lit(epoch), seed)).collect()]
        assert got == [plain_version(x, n, epoch, seed) for x in range(n)]
        assert sorted(got) == list(range(n))


def test_plan_is_the_same_on_any_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("pos"))
    one = rows(training.epoch_plan(df.coalesce(1), 2, 8, 4))
    assert rows(training.epoch_plan(df.repartition(7), 2, 8, 4)) == one
    assert len({r[:3] for r in one}) == len(one) == 1000
    assert max(r[1] for r in one) == 15 and max(r[2] for r in one) == 31
    first, second = ([r[3] for r in one if r[0] == e] for e in (0, 1))
    assert first != second and first != sorted(first)


def test_no_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("pos"))
    assert "Exchange" not in training.epoch_plan(df, 2, 8, 4)._jdf.queryExecution().executedPlan().toString()


def test_no_examples(spark):
    assert training.epoch_plan(spark.range(0).withColumnRenamed("id", "pos"), 2, 8, 4).count() == 0

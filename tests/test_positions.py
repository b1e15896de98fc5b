"""Positions, splits and caps against brute force, with a hot group."""

import random

import pytest
from pyspark.sql import functions as F

from prefloom.operators import positions, splits
from conftest import rows


def sparse(spark, n=5000, seed=1):
    """Unique keys of uneven density, over blocks and spans of every level; group 0 is hot."""
    rng = random.Random(seed)
    keys = set(range(-500, 1500)) | {rng.randrange(1 << 20) for _ in range(n)}
    keys |= {rng.randrange(1 << 33) for _ in range(n // 2)} | {rng.randrange(-(1 << 63), 1 << 63) for _ in range(n // 2)}
    data = [(k, 0 if rng.random() < 0.4 else rng.randrange(1, 30), rng.randrange(5)) for k in keys]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "key bigint, grp int, v int").repartition(5)


def test_numbers_of_the_table(spark):
    data, df = sparse(spark)
    expected = sorted((i, k) for i, (k, _, _) in enumerate(sorted(data)))
    assert rows(positions.number_rows(df, "key"), "pos", "key") == expected


def test_numbers_and_running_sums_per_group(spark):
    data, df = sparse(spark)
    ours = positions.number_rows(df, "key", ["grp"], "no", first=1, running={"total": F.col("v")})
    expected, state = [], {}
    for k, g, v in sorted(data):
        n, t = state.get(g, (0, 0))
        state[g] = (n + 1, t + v)
        expected.append((k, g, *state[g]))
    assert rows(ours, "key", "grp", "no", "total") == sorted(expected)


@pytest.mark.parametrize("n", [0, 1, 7, 2500, 10**6])
def test_first_rows_per_group(spark, n):
    data, df = sparse(spark)
    expected, seen = [], {}
    for k, g, _ in sorted(data):
        seen[g] = seen.get(g, 0) + 1
        if seen[g] <= n:
            expected.append((g, seen[g], k))
    assert rows(positions.first_rows(df, n, "key", ["grp"], "no"), "grp", "no", "key") == sorted(expected)


def test_keys_at_positions(spark):
    data, df = sparse(spark)
    keys = sorted(k for k, _, _ in data)
    wanted = [0, 1, 499, 500, 2000, len(keys) - 1, len(keys), 10**9]
    assert positions.keys_at_positions(df, "key", wanted) == {p: keys[p] for p in wanted if p < len(keys)}
    assert positions.keys_at_positions(df, "key", []) == {}
    assert positions.keys_at_positions(df.filter("false"), "key", [0]) == {}


def test_position_by_any_columns(spark):
    data, df = sparse(spark, 800)
    named = df.select(F.concat(F.lit("g"), "grp").alias("name"), "key", "v")
    placed = positions.with_position(named, ["name", "key"], partitions=7)
    expected = sorted((f"g{g}", k) for k, g, _ in data)
    assert rows(placed, "pos", "name", "key") == [(i, *x) for i, x in enumerate(expected)]


def test_position_of_nothing(spark):
    assert positions.with_position(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("sizes", [(3000, 1000, 50), (10**6, 10, 0), (0, 0, 0), (100, 1500, 400)])
def test_splits(spark, sizes):
    train, pref, evaluation = sizes
    data, df = sparse(spark, 2000)
    keys = sorted(k for k, _, _ in data)
    total = len(keys)
    with pytest.warns(UserWarning) if train + pref + evaluation > total else _nothing():
        parts = splits.split_rows(df, "key", train, pref, evaluation)
    tail = total - evaluation
    expected = {"train": keys[:train], "preference": keys[tail - pref:tail], "evaluation": keys[tail:]}
    assert {n: [r[0] for r in rows(p, "key")] for n, p in parts.items()} == expected


def _nothing():
    from contextlib import nullcontext

    return nullcontext()


def test_split_that_does_not_fit(spark):
    with pytest.raises(ValueError):
        splits.cut_positions(10, 5, 8, 3)


def test_overlap_is_reported():
    with pytest.warns(UserWarning, match="3 train rows"):
        assert splits.cut_positions(10, 8, 4, 1).overlap == 3


@pytest.mark.parametrize("n", [None, 0, 25, 10**6])
def test_first_n(spark, n):
    data, df = sparse(spark, 300)
    keys = sorted(k for k, _, _ in data)
    assert [r[0] for r in rows(splits.first_n(df, n, "key"), "key")] == keys[:n]

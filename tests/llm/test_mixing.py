"""Targets, passes and positions against a loop over the sources."""

import random
from collections import defaultdict

import pytest

from prefloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, target string, _block int"  # clashing names


def shared(sizes, weights=(1, 2, 3), most=3):
    """The rule as told: share by weight, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target | {s: float(most * sizes[s]) for s in capped}
        capped |= above


def invented(seed, n=300):
    rng = random.Random(seed)
    names = [None, "a", "b", "Z", "é", "zz"]
    return [
        (rng.choice([i, i, i, 7, None]), rng.choice([None, "", "w " * rng.randrange(1, 50)]), names[min(5, int(rng.expovariate(1)))], "t", 3)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rows = invented(seed)
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += len((text or "").split())
    expected = shared(sizes)
    # the clashing column is only carried by the whole-document form
    df = spark.createDataFrame(rows, SCHEMA)
    sized = df.select("doc_id", "source", mixing.size_of().alias("size"))
    got = mixing.plan_mix(sized).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(expected[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        assert (r.positions == []) == (r.taken == 0)
        taken[r.source] += r.taken
    for s, t in expected.items():
        assert abs(taken[s] - t) < 1.01
    again = mixing.plan_mix(sized.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    df = spark.createDataFrame(invented(5), SCHEMA).select("doc_id", "source", mixing.size_of().alias("size"))
    whole = sorted(map(str, mixing.plan_mix(df).collect()))
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 3)
    assert sorted(map(str, mixing.plan_mix(df).collect())) == whole


def test_density_follows_the_slope(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan_mix(df.select("doc_id", "source", mixing.size_of().alias("size"))).filter("taken > 0").collect()
    for source, slope in zip("abc", mixing.SLOPES):
        at = [p / mixing.STEPS for r in got if r.source == source for p in r.positions]
        share = sum(t < 0.5 for t in at) / len(at)
        assert share == pytest.approx(0.5 - slope / 4, abs=0.03)


def test_whole_documents(spark):
    rows = invented(6)
    df = spark.createDataFrame(rows, SCHEMA).drop("target", "_block")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r[:3]) for r in rows}
    assert mixing.mixed(df.limit(0)).count() == 0
    assert mixing.mix(df.limit(0)).count() == 0


def test_columns_of_any_name_stay(spark):
    rows = [(i, "ab"[i % 2], 1 + i % 4, 7, i * 10, f"x{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, target int, _block int, _order string")
    got = mixing.plan_mix(df).collect()
    assert sorted((r.doc_id, r._block, r._order) for r in got) == [(r[0], r[4], r[5]) for r in rows]
    plain = {r.doc_id: (r.target, r.taken) for r in mixing.plan_mix(df.select("doc_id", "source", "size")).collect()}
    assert {r.doc_id: (r.target, r.taken) for r in got} == plain

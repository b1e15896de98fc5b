"""Classes and links against a comparison of all documents."""

import random
from pathlib import Path

import numpy as np
import pytest

from prefloom.llm import near, tables

SCHEMA = "doc_id long, text string, rid string, id int"


def shingle_set(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    link = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    for i in range(n):
        stack = [i]
        while stack:
            for j in link[stack.pop()]:
                if label[j] > label[i]:
                    label[j] = label[i]
                    stack.append(j)
    groups = {}
    for i in range(n):
        groups.setdefault(label[i], []).append(rows[i][0])
    name = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted((str(rows[i][0]), str(name[label[i]]), len(link[i])) for i in range(n))


def ours(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in df.collect())


def invented(seed, n=150):
    rng = random.Random(seed)
    base = [[str(rng.randrange(10**6)) for _ in range(rng.randrange(1, 80))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base[: 3 if i % 3 else 12]))  # some large groups
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
        rows.append((i * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,small,sets,per_block", [(1, 64, 256, 500_000), (2, 4, 7, 900)])
def test_equals_comparing_all_documents(spark, monkeypatch, seed, small, sets, per_block):
    monkeypatch.setattr(near, "SMALL", small)
    monkeypatch.setattr(near, "BLOCK_SETS", sets)
    monkeypatch.setattr(near, "BLOCK_SHINGLES", per_block)
    rows = invented(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert ours(near.near_documents(df)) == brute(rows)


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "a  b"), (None, "a b c"), (None, "a b c"), (9, "z " * 100_000), (10, "z " * 90_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert ours(near.near_documents(df)) == brute(rows)
    kept = near.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), (r.text or "")[:3]) for r in kept.collect()) == [("1", ""), ("2", ""), ("3", "a b"), ("9", "z z"), ("None", "a b")]
    assert near.near_documents(df.limit(0)).count() == 0
    assert near.keep_first(df.limit(0)).count() == 0


def test_sketches_and_runs():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    hashes = np.concatenate([a[:800], a[100:]])
    values = near.sketches(hashes, np.array([0, 800, 800, 1600]))
    assert values.shape == (2, near.COORDINATES)
    assert abs((values[0] == values[1]).mean() - 700 / 900) < 0.2
    assert near.runs_needed(0.9995, 4) > near.runs_needed(0.99, 4) > near.runs_needed(0.99, 1)


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c", 5, "r", 7), (2, "a b c", 6, "q", 8), (3, "d", 9, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rid int, rid string, id int")
    assert sorted(map(tuple, near.keep_first(df).collect())) == [rows[0], rows[2]]


def test_components_with_and_without_hubs(spark, monkeypatch):
    links = [(0, i) for i in range(1, 40)] + [(50, 51), (52, 51), (53, 52), (60, 60)]
    df = spark.createDataFrame(links, "a long, b long")
    expected = {**{i: 0 for i in range(40)}, **{i: 50 for i in range(50, 54)}}
    for hubs in (20_000, 3, 0):
        monkeypatch.setattr(tables, "HUBS", hubs)
        assert {r.id: r.component for r in tables.components(df).collect()} == expected


def test_only_the_result_stays_in_the_shared_folder(spark, monkeypatch):
    made = []
    write = tables.scratch_folder
    monkeypatch.setattr(tables, "scratch_folder", lambda s, name: made.append(write(s, name)) or made[-1])
    df = spark.createDataFrame([(i, f"a b c d e f {i % 3}") for i in range(9)], "doc_id long, text string")
    assert near.keep_first(df).count() == 3
    assert [Path(f).name.split("-")[0] for f in made if Path(f).exists()] == ["classes"]


def test_components_with_and_without_hubs(spark, monkeypatch):
    links = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(50, 60)] + [(60, 39), (80, 81)]
    df = spark.createDataFrame(links, "a long, b long")
    expected = {i: 0 if i < 80 else 80 for i in {x for link in links for x in link}}
    for hubs, least in ((8, 0), (1, 0), (20_000, 10_000)):
        monkeypatch.setattr(tables, "HUBS", hubs)
        monkeypatch.setattr(tables, "LEAST_HUB", least)
        assert {r.id: r.component for r in tables.components(df).collect()} == expected


def test_plans_of_a_round_stay_small(spark, monkeypatch):
    sizes = []
    plain = tables.stored

    def watched(df, name):
        sizes.append(df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate"))
        return plain(df, name)

    monkeypatch.setattr(tables, "stored", watched)
    df = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    assert {r.component for r in tables.components(df).collect()} == {0}
    assert max(sizes) == 1  # 34 when both stars were one plan

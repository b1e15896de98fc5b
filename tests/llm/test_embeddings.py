"""Links and components against all cosines; recall, estimates and bounds."""

import math

import numpy as np
import pytest

from prefloom.llm import embeddings as em
from prefloom.llm.queries import QUERIES


def brute(rows, threshold=0.95):
    """(vec_id, n_links, component_id) by all pairs in double precision."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v), g in zip(rows, good)]
    link = [[j for j in range(n) if j != i and good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
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
    return sorted((rows[i][0], len(link[i]), min(groups[label[i]])) for i in range(n))


@pytest.mark.parametrize("block", [512, 6])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(em, "BLOCK", block)
    monkeypatch.setattr(em, "RECALL", 0.99999)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(15, 32))
    rows = []
    for i in range(250):
        v = base[i % 15 if i % 2 else 0] + rng.normal(size=32) * 0.15
        rows.append((i * 3, [float(x) for x in v * rng.uniform(0.1, 9)]))
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(2000, [1.0, 2.0]), (2001, [2.0, 4.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, id int, copies int").repartition(5)
    got = em.near_vectors(df, recall=0.99999).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_defined_results(spark):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows = [*bad, (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [3.0, 0.1]), (10, [1e38, 0.0]), (11, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in em.near_vectors(df).collect())
    assert got == brute(rows)
    assert em.near_vectors(df.limit(0)).count() == 0
    more = spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0])], df.schema)
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in em.near_vectors(more).collect()) == [("3", 1, 3, True), ("None", 1, 3, False)]


def test_query_recall_on_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    unit = np.array([v for _, v in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = ((unit @ unit.T) >= 0.95).sum(axis=1) - 1
    got = {r.vec_id: r for r in QUERIES["op8_near_embeddings"](spark, folder).collect()}
    assert len(got) == len(rows)
    found = np.array([got[i].n_links for i, _ in rows])
    assert (found <= true).all()
    assert found.sum() >= 0.99 * true.sum()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(400, 64)) + 0.2 * rng.normal(size=64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    signs, factors = em.encode(unit)
    cosine, bound = em.estimate(signs, factors, unit)
    error = cosine - unit @ unit.T
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.01
    assert (np.abs(error) <= bound[:, None])[off].mean() > 0.99


def test_buckets_find_pairs_at_the_threshold():
    bits, tables = em.plan_buckets(50_000, 0.95, 0.999)
    rng = np.random.default_rng(3)
    a = rng.normal(size=(500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(500, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * side
    same = em.bucket_codes(a, bits, tables) == em.bucket_codes(b, bits, tables)
    assert same.any(axis=1).mean() > 0.98

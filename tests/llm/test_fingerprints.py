"""Fingerprints: exact edited texts, estimates near the true similarity."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from prefloom.llm import fingerprints as fp
from prefloom.llm.queries import QUERIES


def shingle_set(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a or b else 1.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(text, edited), jaccard(text, after))
    return out


def close(rows, got):
    expected = brute(rows)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    errors = []
    for r in got:
        n, digest, edited, following = expected[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        errors += [r.near_edited - edited, r.near_next - following]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert np.abs(errors).max() < 0.16 and np.abs(np.mean(errors)) < 0.01


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op7_fingerprints"](spark, sf_dir).collect()
    close([tuple(r) for r in docs], got)
    prints = {}
    text = {r.doc_id: r.text for r in docs}
    for r in got:
        assert prints.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint


def test_partitions_meet(spark):
    rng = random.Random(1)
    rows = [(i * 3, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))) for i in range(50)]
    rows += [(None, "é" * 7), (200, None), (201, "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, pid int")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fp.compare_fingerprints(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    expected = brute(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {i: e[:2] for i, e in expected.items()}
    assert len(got) == len(rows)
    empty = [r for r in got if r.doc_id in (200, 201)]
    assert all(r.fingerprint == "" for r in empty)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows_and_repeated_rows(spark, n):
    df = spark.createDataFrame([(5, "a b c d e f")] * n, "doc_id long, text string")
    got = fp.compare_fingerprints(df).collect()
    assert len(got) == n
    assert all(r.near_next == 1.0 and r.fingerprint == got[0].fingerprint for r in got)


def test_both_ways_of_filling_bins_agree():
    rng = random.Random(3)
    orders = fp.bin_orders()
    ranks = np.argsort(orders, axis=1).astype(np.int16)
    for size in (20, 40, 60, 90, 3000):
        text = " ".join(str(rng.randrange(10**6)) for _ in range(size))
        value = fp.fingerprints(pa.array([text]), orders, ranks)[0]
        assert (value >= 0).all()
        again = fp.fingerprints(pa.array(["", text]), orders, ranks)
        assert (again[1] == value).all() and again[0, 0] == -1

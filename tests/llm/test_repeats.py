"""Repeated windows against a count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from prefloom.llm import repeats
from prefloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, rid string, h int"  # extra columns with clashing names


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[s : s + window]) for _, w in words for s in range(len(w) - window + 1))
    out = []
    for i, w in words:
        keep = [True] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                keep[s : s + window] = [False] * window
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def ours(df):
    return Counter(tuple(r) for r in df.collect())


def invented(seed, n=60, vocabulary=6, longest=90):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh"[:vocabulary]) for _ in range(rng.randrange(longest))] for _ in range(n // 3)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            if text:
                text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(text + rng.choice(base)[:30])))
    return rows


@pytest.mark.parametrize("seed,window", [(1, 12), (2, 20), (3, 9)])
def test_equals_counting_every_window(spark, seed, window):
    rows = invented(seed)
    df = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA).repartition(5)
    assert ours(repeats.remove_repeats(df, window, shard_words=300)) == brute(rows, window)


def test_hot_anchors_window_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_LEAST", 3)
    monkeypatch.setattr(repeats, "HOT_LIST", 10**9)
    rows = invented(4, n=80)
    df = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA).repartition(3)
    assert ours(repeats.remove_repeats(df, 12, shard_words=300)) == brute(rows, 12)


def test_nulls_empty_repeated_and_monotonous(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (5, "same " * 400), (6, " ".join(map(str, range(500))))]
    rows += [(7, " ".join(map(str, range(300, 340))))] * 2 + [(None, None), (8, "\x0b\x0c ")]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], SCHEMA)
    assert ours(repeats.remove_repeats(df)) == brute(rows, 35)
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert ours(QUERIES["op1_remove_repeats"](spark, sf_dir)) == brute([tuple(r) for r in docs.collect()], 35)


def test_automaton_counts_occurrences():
    rng = random.Random(7)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(25))] for _ in range(12)]
    automaton = repeats.SuffixAutomaton()
    for t in texts:
        automaton.add(t, 2)
    automaton.close()
    for window in (1, 2, 5):
        seen = Counter(tuple(t[s : s + window]) for t in texts for s in range(len(t) - window + 1))
        other = [rng.randrange(4) for _ in range(60)]
        expected = [e for e in range(window, 61) if 2 * seen[tuple(other[e - window : e])] >= 4]
        assert automaton.repeated_ends(other, window, least=4) == expected


def test_leftmost_smallest():
    values = np.array([3, 1, 1, 2, 0, 5, 5, 5], dtype=np.uint64)
    assert repeats.sliding_argmin(values, 3).tolist() == [1, 1, 4, 4, 4, 5]

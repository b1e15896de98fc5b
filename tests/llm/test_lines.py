"""Removed lines against a comparison of all lines."""

import random

import numpy as np
import pyarrow as pa
import pytest

from prefloom.llm import lines

SCHEMA = "doc_id long, text string, line int, rid string"


def brute(rows, threshold=0.8):
    """Per (doc_id, text): numbers of the removed lines."""
    seen, out = [], {}
    for i, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0)):
        gone = []
        for k, line in enumerate(text.split("\n")):
            own = set(line.encode().split())
            if not own:
                continue
            if any(len(own & s) >= threshold * len(own | s) - 1e-9 for s in seen):
                gone.append(k)
            seen.append(own)
        out[i, text] = gone
    return out


def invented(seed, n=60):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(3)) for _ in range(rng.randrange(1, 14))] for _ in range(12)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(5)):
            line = list(rng.choice(base))
            if rng.random() < 0.6:
                line[rng.randrange(len(line))] = f"x{rng.randrange(40)}"
            text.append(rng.choice(["", " ", "\t"]) + rng.choice([" ", "  "]).join(line))
        rows.append((i, "\n".join(text)))
    return rows


@pytest.mark.parametrize("seed,neighbours", [(1, 5), (2, 0), (3, 1)])
def test_equals_comparing_all_lines(spark, monkeypatch, seed, neighbours):
    monkeypatch.setattr(lines, "NEIGHBOURS", neighbours)
    rows = invented(seed)
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    expected = brute(rows)
    got = lines.line_report(df).collect()
    assert {r.doc_id: r.removed for r in got} == {i: ",".join(map(str, g)) for (i, _), g in expected.items()}
    assert all(r.n_removed == len([x for x in r.removed.split(",") if x]) for r in got)


def test_defined_results(spark):
    rows = [(1, "a b\n\nc d"), (2, None), (3, ""), (4, "a  b"), (4, "a  b"), (None, "c d\nq"), (9, "z " * 50_000), (10, " z")]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.n_lines, r.removed) for r in lines.line_report(df).collect())
    assert got == sorted(
        [("1", 3, ""), ("2", 0, ""), ("3", 1, ""), ("4", 1, "0"), ("4", 1, "0"), ("None", 2, "0"), ("9", 1, ""), ("10", 1, "0")]
    )
    out = lines.remove_lines(df)
    assert out.columns == df.columns
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert texts == {(1, "a b\n\nc d"), (2, None), (3, ""), (None, "q"), (9, "z " * 50_000)}
    assert lines.line_report(df.limit(0)).count() == 0
    assert lines.remove_lines(df.limit(0)).count() == 0


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rows = invented(4, 80)
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA).coalesce(1)
    for name, value in (("CHUNK_ROWS", 7), ("NEIGHBOURS", 2)):
        monkeypatch.setattr(lines, name, value)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.doc_id: r.removed for r in lines.line_report(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {i: ",".join(map(str, g)) for (i, _), g in brute(rows).items()}


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c", 5, "r", [1], 7), (2, "a b c\nd", 6, "q", [2], 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _rid int, rid string, _removed array<int>, line int")
    assert sorted(map(tuple, lines.remove_lines(df).collect())) == [rows[0], (2, "d", 6, "q", [2], 8)]


def test_rare_words_are_told_from_others(spark):
    # 200,000 words that come once: with 65,536 counts the usual one looked as if it came several times
    texts = [(i, " ".join(f"w{i * 1000 + k}" for k in range(1000))) for i in range(200)]
    levels = lines.rarity(spark.createDataFrame(texts, "doc_id long, text string"))
    words = lines.split_words(pa.array([t for _, t in texts]))
    own = levels[(words.hashes % np.uint64(lines.BUCKETS)).astype(np.int64)]
    assert len(own) == 200_000 and np.median(own) == 8  # 8 * log2(1 + 1)


@pytest.mark.parametrize("neighbours", [0, 2, 40])
def test_documents_with_one_id_are_ordered_by_their_hash(spark, monkeypatch, neighbours):
    monkeypatch.setattr(lines, "NEIGHBOURS", neighbours)
    rows = [(i // 6, text) for i, text in invented(5, 120)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    rids = {(r.doc_id, r.text): r.h for r in df.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS h").collect()}
    # the order is by line number before it is by hash
    seen, gone = [], {}
    for i, k, _, text in sorted({(i, k, rids[i, t], t) for i, t in rows for k in range(t.count("\n") + 1)}):
        own = set(text.split("\n")[k].encode().split())
        if own and any(len(own & s) >= 0.8 * len(own | s) - 1e-9 for s in seen):
            gone.setdefault((i, text), []).append(k)
        seen += [own] if own else []
    found = {(r.rid, *r.removed) for r in lines.removed_lines(df).collect()}
    assert found == {(rids[key], *ks) for key, ks in gone.items()}


def test_near_copies_are_not_paired_with_each_other(spark, monkeypatch):
    asked, kept = [], lines.stored

    def stored(df, name):
        table = kept(df, name)
        if name in ("pairs", "asked"):
            asked.append(table.count())
        return table

    monkeypatch.setattr(lines, "stored", stored)
    base = [f"w{k}" for k in range(30)]
    rng = random.Random(6)
    rows = []
    for i in range(400):
        own = list(base)
        own[rng.randrange(30)] = f"own{i}"
        rows.append((i, " ".join(own), 5, "x"))
    got = lines.line_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_removed for r in got) == 399
    # 79,800 pairs are similar
    assert max(asked) <= 400 * 8


def test_runs_no_python_on_the_executors(spark, monkeypatch):
    plans, kept = [], lines.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(lines, "stored", stored)
    df = spark.createDataFrame([(1, "a b c d e", 5, "x"), (2, "a b c d e\nf", 6, "y")], SCHEMA)
    for out in (lines.line_report(df), lines.remove_lines(df)):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert out.count() == 2
    assert len(plans) > 10
    assert not [p for p in plans if any(word in p for word in ("Python", "Pandas", "Arrow"))]

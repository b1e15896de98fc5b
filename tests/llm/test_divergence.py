"""Source divergence against a plain version in Python integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from prefloom.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_version(rows, least=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        mates = [s for g, s in groups if g == lang]

        def share(n):
            total = sum(n.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (n.get(t, 0) + 2) // (total + 2 * len(kept)) for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p = share(counts[lang, source])
        pair = []
        for other in mates:
            if other != source:
                q = share(counts[lang, other])
                pair.append((other, sum(gap(p[t], q[t]) for t in kept)))
        q = share(sum((counts[lang, s] for s in mates), Counter()))
        term = [(t, gap(p[t], q[t])) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, ranks in (("pair", pair, None), ("term", term, 10)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:ranks]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items)]
    return sorted(out)


def compare(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = sorted(tuple(r) for r in divergence.divergence(df, **options).collect())
    assert got == plain_version(rows, **options)
    return got


def corpus(seed, n, sources=5):
    rng = random.Random(seed)
    words = ["The", "the,", "cat", "CAT's", "naïve", "ÉTÉ", "été", "x1y", "中文", "a-b", "Ä", "ä", "--", "9", "don't"]
    words += [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", " ", "", "."]) for _ in range(rng.randrange(25)))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "de", None, ""]), rng.choice([f"s{rng.randrange(sources)}", None])))
    return rows


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_against_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    got = compare(spark, corpus(1, 400))
    assert {r[2] for r in got} == {"pair", "term"}


def test_sources_with_separators(spark):
    names = ["a\x1fb", "a\x1eb", "\x1e\x1fu", "\x1eu", "", "a,b", "\x1f"]
    rows = [(f"word common {chr(97 + i % 9)}", "en", s) for i in range(6) for s in names]
    compare(spark, rows, least=2)


def test_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 16)
    compare(spark, corpus(2, 300, sources=9), least=2)


def test_hot_source_repeated_rows_and_ties(spark):
    rows = corpus(3, 100) + [("same text here Same", "en", "hot")] * 300 + [("solo", "xx", "only")] * 12
    compare(spark, rows)


def test_no_kept_terms_and_long_texts(spark):
    few = [("a b c", "en", "s1"), ("a b d", "en", "s2"), (None, None, None)]
    assert [r[2:5] for r in compare(spark, few)] == [("pair", "s2", 0), ("pair", "s1", 0)]
    compare(spark, [("z" * 1_000_000 + " ab" * 100_000, "en", f"s{i % 2}") for i in range(10)])


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.divergence(df).collect() == []
    rows = corpus(4, 60)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for name in ("term", "block", "n", "docs", "p", "q", "terms", "value", "item", "bucket"):
        df = df.withColumn(name, df["source"])
    assert sorted(tuple(r) for r in divergence.divergence(df, least=3).collect()) == plain_version(rows, least=3)


def test_a_chunk_is_cut_once_for_all_documents(spark):
    rows = [("Don't,stop don't", "en", "a")] * 30
    partial, groups = divergence.term_counts(spark.createDataFrame(rows, "text string, lang string, source string"))
    found = sorted((r.lang, r.term, r.docs, r.sources, r.counts) for r in partial.collect())
    docs = {t: sum(r[2] for r in found if r[1] == t) for t in ("don", "stop", "t")}
    times = {t: sum(sum(map(int, r[4].split(","))) for r in found if r[1] == t) for t in docs}
    assert docs == {"don": 30, "stop": 30, "t": 30} and times == {"don": 60, "stop": 30, "t": 60}
    assert [tuple(r) for r in groups.collect()] == [("en", "a")]

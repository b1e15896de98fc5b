"""Hidden Markov scores: base scores, likelihoods and training by definition."""

import itertools
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from prefloom.llm import hmm
from prefloom.llm.queries import QUERIES
from prefloom.llm.tables import stored


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + ["\0end"]


def check_base(rows, got):
    train = Counter()
    for i, text in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            train.update(tokens(text))
    n, v = sum(train.values()), len(train)
    expected = []
    for i, text in rows:
        t = tokens(text)
        expected.append((str(i), len(t), sum(train[w] > 0 for w in t), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t)))
    ours = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for a, b in zip(ours, sorted(expected), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9, abs=1e-9)


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_score_texts"](spark, sf_dir).collect()
    check_base(rows, got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    # the states tell more than word frequencies alone
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_beyond_the_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(hmm, "TABLE", 40)
    monkeypatch.setattr(hmm, "SYMBOLS", 20)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 2000").select("doc_id", "text", "source")
    check_base([tuple(r)[:2] for r in df.collect()], hmm.score_texts(df, rounds=1).collect())


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (None, "A a B"), (4, "x " * 9000), (5, "a"), (5, "a"), (6, "\x0b \r")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    got = hmm.score_texts(df).collect()
    check_base(rows, got)
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    assert hmm.score_texts(df.limit(0)).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    alone = hmm.score_texts(spark.createDataFrame([(held[0], "a b")], "doc_id long, text string")).first()
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0.0)


def random_model(states=3, symbols=5, seed=1):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((symbols, states))
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, text):
    """Probability of every path of states."""
    for path in itertools.product(range(len(model.start)), repeat=len(text)):
        p = model.start[path[0]] * model.emit[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:]):
            p *= model.move[a, b] * model.emit[x, b]
        yield path, p


def likelihoods(model, texts):
    flat = np.concatenate(texts)
    return hmm.log10_likelihood(model, lambda at: model.emit[flat[at]], np.array([len(t) for t in texts]))


def cut_short(monkeypatch):
    for name, value in (("LONG", 2), ("PIECE", 2), ("CHUNK", 5)):
        monkeypatch.setattr(hmm, name, value)


def test_likelihood_sums_all_paths(monkeypatch):
    model, rng = random_model(), np.random.default_rng(2)
    texts = [rng.integers(0, 5, n) for n in (1, 6, 3, 7, 1)]
    expected = [math.log10(sum(p for _, p in paths(model, t))) for t in texts]
    assert np.allclose(likelihoods(model, texts), expected)
    cut_short(monkeypatch)
    assert np.allclose(likelihoods(model, texts), expected)


def by_paths(model, texts):
    """Expected emissions, transitions and starts, and the log likelihood, from every path."""
    symbols, states = model.emit.shape
    emission, moves, starts = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
    log = 0.0
    for text in texts:
        total = sum(p for _, p in paths(model, text))
        log += math.log(total)
        for path, p in paths(model, text):
            starts[path[0]] += p / total
            for s, x in zip(path, text):
                emission[x, s] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
    return emission, moves, starts, log


@pytest.mark.parametrize("cut", [False, True])
def test_expected_counts_sum_all_paths(monkeypatch, cut):
    """Also over the pieces of long texts: no transition is lost."""
    model, rng = random_model(), np.random.default_rng(3)
    texts = [rng.integers(0, 5, n) for n in (5, 2, 7, 1)]
    if cut:
        cut_short(monkeypatch)
    flat, emission = np.concatenate(texts), np.zeros((5, 3))

    def add(at, gammas):
        np.add.at(emission, flat[at], gammas)

    got = hmm.expected_counts(model, lambda at: model.emit[flat[at]], np.array([len(t) for t in texts]), add)
    for ours, theirs in zip((emission, *got), by_paths(model, texts)):
        assert np.allclose(ours, theirs)


def test_likelihood_rises(spark):
    rng = np.random.default_rng(4)
    texts = [(hmm.packed(rng.integers(0, 3, 40) + 4 * (i % 2)),) for i in range(60)]
    df = spark.createDataFrame([(bytearray(t[0]),) for t in texts], "symbols binary").repartition(4)
    tie = np.arange(8 + hmm.CLASSES + 1)
    model, logs = hmm.baum_welch(df, tie, np.ones(len(tie)), np.ones(len(tie)), rounds=6, states=2)
    assert all(b > a for a, b in zip(logs, logs[1:]))


def fold(i):
    return zlib.crc32(str(i).encode()) % 7


def word_class(word):
    if word == "\0end":
        return hmm.CLASSES
    raw = word.encode()
    return ((raw[-2] if len(raw) > 1 else 0) * 31 + raw[-1]) % hmm.CLASSES


def plain_scores(rows, rounds, states=hmm.STATES):
    """The whole model by its definition, word by word and text by text, one array of states a token."""
    texts = {i: tokens(t) for i, t in rows}
    train = [t for i, t in texts.items() if fold(i) != 2]
    count = Counter(w for t in train for w in t)
    # one symbol per counted word, then one per class of unseen words
    hashes = {"\0end": hmm.END}
    for w in count:
        if w != "\0end":
            hashes[w] = int(hmm.split_words(hmm.pa.array([w]), lower=True).hashes[0])
    signed = {w: h - (1 << 64) if h >= 1 << 63 else h for w, h in hashes.items()}
    ranked = sorted(count, key=lambda w: (-count[w], signed[w]))
    own = ranked[: hmm.SYMBOLS]
    if "\0end" not in own and len(ranked) > hmm.TABLE:
        assert hmm.TABLE >= hmm.SYMBOLS
    tied = {w: i for i, w in enumerate(own)}
    size = len(own) + hmm.CLASSES + 1

    def row(w):
        return tied.get(w, len(own) + word_class(w))

    units = np.ones(size)
    weights = np.ones(size)
    for w in count:
        weights[row(w)] += count[w] + (w not in tied)
        units[row(w)] += w not in tied
    model = hmm.first_model(weights, states)

    def counts(model):
        emission, moves, starts = Counter(), np.zeros((states, states)), np.zeros(states)
        for t in train:
            e = [model.emit[row(w)] for w in t]
            alpha, beta = [model.start * e[0]], [np.ones(states)]
            alpha[0] = alpha[0] / alpha[0].sum()
            for x in e[1:]:
                a = alpha[-1] @ model.move * x
                alpha.append(a / a.sum())
            for x in e[:0:-1]:
                b = model.move @ (x * beta[0])
                beta.insert(0, b / b.sum())
            for k, w in enumerate(t):
                g = alpha[k] * beta[k]
                emission[w] = emission[w] + g / g.sum()
                if k:
                    m = alpha[k - 1][:, None] * model.move * (e[k] * beta[k])[None, :]
                    moves += m / m.sum()
            g = alpha[0] * beta[0]
            starts += g / g.sum()
        return emission, (starts + 0.1) / (starts + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)

    for _ in range(rounds - 1):
        emission, start, move = counts(model)
        emit = (units / states + states * weights / weights.sum())[:, None] + np.zeros(states)
        for w, g in emission.items():
            emit[row(w)] += g
        model = hmm.Model(start, move, emit / emit.sum(axis=0))
    emission, start, move = counts(model)
    total = weights.sum()
    last = {w: emission[w] + 1 / states + states * (count[w] + 1) / total for w in count}
    unseen = np.full(states, 1 / states + states / total)
    norm = sum(last.values()) + (hmm.CLASSES + 1) * unseen
    out = {}
    for i, t in texts.items():
        log, a = 0.0, None
        for w in t:
            a = (start if a is None else a @ move) * last.get(w, unseen) / norm
            log, a = log + math.log10(a.sum()), a / a.sum()
        out[i] = log
    return out


@pytest.mark.parametrize(("symbols", "table", "long"), [(16_384, 200_000, 2_048), (20, 60, 2_048), (20, 60, 40)])
def test_scores_by_definition(spark, sf_dir, monkeypatch, symbols, table, long):
    """The whole query's scores, with words beyond the table, long texts in pieces, and the end outside the table."""
    for name, value in (("SYMBOLS", symbols), ("TABLE", table), ("LONG", long), ("PIECE", 16), ("CHUNK", 700)):
        monkeypatch.setattr(hmm, name, value)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 2000").orderBy("doc_id").limit(60)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()] + [(100_001, "Only here"), (100_002, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_scores(rows, 3)
    got = {r.doc_id: r.score for r in hmm.score_texts(df, rounds=3).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_many_words(spark):
    """More distinct words than are tied apart; all of them are in force."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 30_000, 1_500))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = hmm.score_texts(df, rounds=2).collect()
    check_base(rows, got)
    assert {r.doc_id: r.score for r in got} == pytest.approx(plain_scores(rows, 2), rel=1e-9)


def test_an_end_rarer_than_the_table_is_known(spark, monkeypatch):
    """Few long texts: some words come more often than texts end."""
    texts = [" ".join(f"w{j % 6} w{j % 3} only{i}x{j % 4}" for j in range(40)) for i in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: tuple(r) for r in hmm.score_texts(df, rounds=0).collect()}
    train = [i for i in range(8) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for i in train for w in [*texts[i].split(), None])
    total, distinct = sum(count.values()), len(count)
    monkeypatch.setattr(hmm, "TABLE", 3)
    assert count[None] < sorted(count.values())[-3]
    for r in hmm.score_texts(df, rounds=0).collect():
        tokens = [*texts[r.doc_id].split(), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(count[w] > 0 for w in tokens), total)
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens)
        assert abs(r.base_score - base) < 1e-6 and r.n_known == want[r.doc_id][3]


def test_word_counts_go_once_read(spark, monkeypatch):
    made = []
    monkeypatch.setattr(hmm, "stored", lambda df, name: made.append((name, stored(df, name))) or made[-1][1])
    df = spark.createDataFrame([(i, f"a b{i} c") for i in range(20)], "doc_id long, text string")
    scored = hmm.score_texts(df)
    left = [name for name, table in made if os.path.exists(table.scratch_path)]
    assert left == ["encoded", "expected"]  # which the result reads
    assert scored.count() == 20

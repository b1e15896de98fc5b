"""Languages: held-out accuracy, counts and scores against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from prefloom.llm import language
from prefloom.llm.queries import QUERIES


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, size):
    folder = f"/root/testdata/{size}"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op9_identify_language"](spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def small(spark):
    rows = [(1, "der Hund und die Katze", "de", 1), (2, "the dog and the cat", "en", 2), (3, "the end, der 42", "en", 3)]
    rows += [(4, None, "en", 4), (5, "xyz", None, 5), (5, "xyz", None, 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def test_frequencies_and_backoff(spark):
    df = small(spark)
    model = language.train(df)
    assert model.langs == ["de", "en"]
    count = Counter()
    for r in df.filter("text is not null and lang is not null").collect():
        count.update((r.lang, w) for w in re.findall(r"[a-z]+", r.text.lower()))
    total = {lang: sum(n for (k, _), n in count.items() if k == lang) for lang in model.langs}
    assert set(model.words) == {w for _, w in count}
    for word, logs in zip(model.words, model.word_logs):
        for lang, value in zip(model.langs, logs):
            p = (count[lang, word] + 0.5) / (total[lang] + 0.5 * (len(model.words) + 1))
            assert value == pytest.approx(math.log(p), abs=1e-5)
    scorer = language.Scorer(model)
    # "hunde" is unseen: <hund, hund are known 5- and 4-grams, <hund comes first
    assert np.allclose(scorer.backoff(["hunde"]), scorer.gram_logs[[scorer.grams["<hund"]]].mean(axis=0))
    assert scorer.backoff(["qqq"]).tolist() == [[0, 0]]
    assert scorer.predict(["Hunde"])[0][0] == "de"
    text = "the hunde ende 12 the"
    total = sum(scorer.word_logs[scorer.place[w]] if w in scorer.place else scorer.backoff([w])[0] for w in ["the", "hunde", "ende", "the"])
    assert scorer.predict([None, text, ""])[1][1] == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_defined_results(spark):
    model = language.train(small(spark))
    rows = [(1, None), (2, ""), (3, "42 ² _!"), (4, "the " * 300_000), (5, "the"), (5, "the"), (None, "ДА")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, (r.text or "")[:4]): (r.lang_pred, r.score) for r in language.predict(df.withColumn("held", df.text.isNull()), model, "doc_id", "held").join(df, "doc_id", "left").collect()}
    assert [got[1, ""], got[2, ""], got[3, "42 ²"]] == [("und", 0.0)] * 3
    assert got[4, "the "][0] == got[5, "the"][0] == "en" and got[None, ""][0] in ("de", "en")
    nothing = language.train(small(spark).limit(0))
    assert {r.lang_pred for r in language.predict(df, nothing, "doc_id").collect()} == {"und"}
    assert language.identify(small(spark).limit(0)).count() == 0


def test_units_beyond_the_broadcast_ones_count(spark):
    """A model with few units in memory gives the results of one that holds all of them."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    train, both = docs.filter("doc_id % 3 <> 0"), small(spark).drop("score").unionByName(docs)
    both = both.unionByName(spark.createDataFrame([(-1, "hundehundehunde zzzzzz the", None), (-2, "42 ²", None)], both.schema))
    whole = language.train(train, grams=1_000_000)
    few = language.train(train, words=50, grams=30)
    assert whole.whole and len(few.words) == 50 and len(few.grams) == 30
    place = {w: i for i, w in enumerate(whole.words)}
    assert np.allclose(few.word_logs, whole.word_logs[[place[w] for w in few.words]])
    want, got = (sorted((r.doc_id, r.lang_pred, round(r.score, 6)) for r in language.predict(both, m, "doc_id").collect()) for m in (whole, few))
    assert got == want

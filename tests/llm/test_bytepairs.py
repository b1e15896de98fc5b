"""Byte-pair ids equal those of the library on whole texts, also where texts are joined."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from prefloom.llm import bytepairs
from prefloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def encoder():
    return bytepairs.Encoder(bytepairs.tokenizer_file())


def whole(encoder, text):
    got = encoder.model.encode(text, add_special_tokens=False)
    return got.ids, np.diff([-1, *got.word_ids]) != 0


def check(encoder, text, leaf):
    ids, new = whole(encoder, text)
    parts = [encoder.whole(p.decode()) for p in bytepairs.leaves(text.encode(), leaf)]
    if parts:
        joined = bytepairs.tree(encoder, parts)
        assert joined[0].tolist() == ids and (joined[1] == new).all(), (text[:200], leaf)
    flat, borders, first = encoder.batch(pa.array([text, None, text]))
    assert flat.tolist() == ids * 2 and first.tolist() == [0, len(ids), len(ids), 2 * len(ids)]
    assert (borders == [*new, *new]).all()


PIECES = st.one_of(
    st.text(max_size=30),
    st.sampled_from(["<|endoftext|>", "<|endo", "ftext|>", "'re", "'s", " ", "\n", "  ", " ", "　", "́", "中文", "😀"]),
    st.tuples(st.sampled_from(["a", "ab", "!", "'", " ", "\n", "é", "中", "12", "the", "ingly"]), st.integers(1, 300)).map(lambda x: x[0] * x[1]),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=8).map("".join), st.sampled_from([1, 5, 40, 200]))
def test_tree_equals_library(encoder, text, leaf):
    check(encoder, text, leaf)


@pytest.mark.parametrize("alphabet", ["abc", "aab", "é中文あ", " \n\t", "!?'s", "0123456789", "ab '\n中<|>", "the ing of"])
def test_long_unsplit_texts(encoder, alphabet):
    rng = random.Random(alphabet)
    for size in (300, 5000):
        text = "".join(rng.choice(alphabet) for _ in range(size))
        for leaf in (64, 1000):
            check(encoder, text, leaf)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(encoder, doc_id, text):
    ids = whole(encoder, text or "")[0]
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(encoder.model.decode(ids, skip_special_tokens=False))


def key(row):
    return [(v is not None, v) for v in row]


def test_query_equals_library_on_whole_table(spark, encoder):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op13_encode_bytes"](spark, folder).collect())
    assert got == sorted(want(encoder, *r) for r in docs)
    assert any(len(r.text.encode()) > bytepairs.LONG for r in docs)


def test_odd_rows_in_many_leaves(spark, encoder):
    rng = random.Random(5)
    texts = ["", None, " ", "<|endoftext|>", "x" * 3000, "中文字" * 900, "word " * 700, "\n" * 500, "a" * 41]
    texts += ["".join(rng.choice("ab c'sé中\n!7") for _ in range(1500)) for _ in range(10)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id " * 99), (4, texts[4]), (4, texts[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", pa_free_column())
    coded = bytepairs.encode(df, long=40, leaf=16)
    got = sorted(((r.doc_id, r.ids) for r in coded.collect()), key=key)
    assert got == sorted(((i, whole(encoder, t or "")[0]) for i, t in rows), key=key)
    back = bytepairs.decode(coded, "doc_id").collect()
    assert sorted(((r.doc_id, r.decoded) for r in back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def pa_free_column():
    from pyspark.sql import functions as F

    return F.lit("a column of that name")


def test_very_long_text(spark, encoder):
    rng = random.Random(6)
    text = "".join(rng.choice(["lorem", "ipsum ", "dolor", "\n", "é"]) for _ in range(200_000)) + "z" * 50_000
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [tuple(r) for r in bytepairs.report(df).collect()] == [want(encoder, 1, text)] * 2


def test_kept_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "rid"), (2, "c" * 50, None)], "doc_id long, text string, kept string")
    coded = bytepairs.encode(df, "text", "kept", "doc_id", long=20, leaf=16)
    assert coded.columns == ["text", "kept", "doc_id", "ids"]
    assert sorted((r.doc_id, r.text, r.kept) for r in coded.collect()) == [(1, "a b", "rid"), (2, "c" * 50, None)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bytepairs.report(empty).collect() == [] and bytepairs.encode(empty).collect() == []


def test_forgetting_does_not_change_ids(encoder, monkeypatch):
    monkeypatch.setattr(bytepairs, "REMEMBERED", 5000)
    for borders in (True, False):
        small = bytepairs.Encoder(bytepairs.tokenizer_file(), borders)
        held = []
        for k in range(3):
            text = " ".join(f"word{i % 50 + k} and" for i in range(500))
            assert small.batch(pa.array([text]))[0].tolist() == whole(encoder, text)[0]
            held.append(len(small.known))
        assert 0 < held[0] == held[1] == held[2]


def test_other_kinds_of_tokenizer_are_refused():
    import json

    spec = json.loads(bytepairs.tokenizer_file())
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        bytepairs.Encoder(json.dumps(spec))

"""Pieces against the installed library, all segmentations, and other cuts of the text."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from prefloom.llm import pieces
from prefloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # unigram
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def small(seed=1, across=False):
    rng = random.Random(seed)
    some = {"a", "b", "c", pieces.SPACE} | {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
    some |= {pieces.SPACE + p for p in list(some)[:10] if p[0] != pieces.SPACE}
    if across:
        some |= {"a" + pieces.SPACE + "b"}
    rows = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    return pieces.Vocabulary(rows + [(p, -float(rng.randrange(2, 9)), 1) for p in sorted(some)])


def total(vocabulary, ids):
    score = {vocabulary.ids[p]: s for p, s in vocabulary.score.items()}
    return sum(score.get(i, 0) for i in ids)


def all_best(vocabulary, text):
    """Largest sum over all segmentations into pieces, by trying each."""
    if not text:
        return 0
    tries = []
    for n in range(1, min(len(text), vocabulary.reach) + 1):
        s = vocabulary.score.get(text[:n], vocabulary.unknown if n == 1 else None)
        if s is not None:
            tries.append(s + all_best(vocabulary, text[n:]))
    return max(tries)


@pytest.mark.parametrize("across", [False, True])
def test_matrices_give_the_best_of_all_segmentations(across):
    rng = random.Random(2)
    v = small(across=across)
    for _ in range(25):
        text = "".join(rng.choice("abc x"[:4]).replace(" ", pieces.SPACE) for _ in range(11))
        best = all_best(v, text)
        assert v.gains(text, [0], len(text))[0] == best
        assert v.matrix(text, "")[0, 0] == best
        cut = rng.randrange(v.reach, 10)
        both = pieces.combine(v.matrix(text[:cut], text[cut : cut + v.reach - 1]), v.matrix(text[cut:], ""))
        assert both[0, 0] == best


def test_matrix_with_words_equals_matrix_without(vocabulary):
    text = vocabulary.prepared("the quick brown fox " * 20 + "12 ok\n\n  x")
    plain = pieces.load()
    plain.stretch = None
    for core, ahead in ((text, ""), (text[:100], text[100:115]), (text[:97], text[97:112])):
        assert (vocabulary.matrix(core, ahead) == plain.matrix(core, ahead)).all()


@pytest.mark.parametrize("across", [False, True])
def test_chunks_do_not_change_the_ids(spark, across):
    rng = random.Random(3)
    v = small(across=across)
    texts = ["".join(rng.choice("aaabbc é\n") for _ in range(rng.choice([0, 3, 30, 200]))) for _ in range(30)] + ["a" * 300, "x" * 70]
    df = spark.createDataFrame([(i, t, None, i) for i, t in enumerate(texts)], "rid long, text string, ids string, chunk int")
    expected = {i: v.encode(v.prepared(t)) for i, t in enumerate(texts)}
    for chunk in (v.reach + 1, 17, 64, 10_000):
        got = pieces.encode(df, v, chunk).collect()
        assert {r.rid: r.ids for r in got} == expected
        assert all(r.chunk == r.rid for r in got)


def test_all_at_once_equals_one_by_one(monkeypatch):
    # ties and unknown characters; the longest stretches go one by one
    rng = random.Random(5)
    for seed, together in ((1, 64), (2, 4), (3, 1), (4, 64)):
        monkeypatch.setattr(pieces, "TOGETHER", together)
        v = small(seed)
        if seed == 4:
            v.bytes = {}
        texts = ["".join(rng.choice("aaabbc  é\n\U0001f642") for _ in range(rng.choice([0, 1, 5, 40]))) for _ in range(200)]
        texts = [v.prepared(t) for t in texts]
        flat, cuts = v.encode_all(texts)
        got = [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
        assert got == [v.encode(t) for t in texts]
        assert v.encode_all([])[0].tolist() == [] and v.encode_all(["", ""])[1].tolist() == [0, 0, 0]
        lists = pa.array([*got, None], pa.list_(pa.int32())).slice(3)
        plain = [b"".join(v.surface[i] for i in ids).decode("utf-8", "replace") for ids in [*got[3:], []]]
        assert v.decode_all(lists) == [t.removeprefix(" ") for t in plain]


def test_equal_words_cost_no_python_each(vocabulary):
    # a word of its own in every place: by word in Python this took 17 microseconds each
    words = [f"w{i:x}q{i * 7919 % 10007:x}" for i in range(100_000)]
    texts = [vocabulary.prepared(" ".join(words[k : k + 1000])) for k in range(0, len(words), 1000)]
    vocabulary.trie
    before = time.process_time()
    vocabulary.encode_all(texts)
    together = time.process_time() - before
    before = time.process_time()
    for t in texts[:25]:
        vocabulary.encode(t)
    assert together < 2 * (time.process_time() - before)  # half of one by one


def test_equals_the_library_as_unigram(spark, sf_dir, vocabulary, library):
    # the library's lattice search in single precision, exact for short texts of known
    # characters; its faster plain encoding misses some best paths by a few units
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "replace(substr(text, 1, 200), '\\n', ' ') AS text")
    rows = pieces.encode(docs, vocabulary).collect()
    same = 0
    for r in rows:
        theirs = library.nbest_encode_as_ids(r.text, 2)[0]  # one would be the plain encoding
        if total(vocabulary, r.ids) < -(10**8):  # unknown characters, or runs of spaces
            same += 1
            continue
        assert total(vocabulary, r.ids) == total(vocabulary, theirs)  # equal sums, perhaps another of equal paths
        same += r.ids == theirs
    assert same > 0.5 * len(rows)
    back = pieces.decode(pieces.encode(docs, vocabulary), vocabulary, "doc_id", "text").collect()
    assert all(r.decoded == r.text for r in back) and len(back) == len(rows)
    assert all(library.decode(r.ids) == r.text for r in rows)


def test_query_on_whole_table(spark, sf_dir):
    rows = QUERIES["op3_encode_pieces"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.round_trip for r in rows)


def test_defined_results(spark, vocabulary):
    rows = [(1, None), (2, ""), (3, "  two  spaces "), (3, "  two  spaces "), (None, "emoji \U0001f642 \t\r\n"), (5, "no" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    coded = pieces.encode(df, vocabulary)
    got = pieces.decode(coded, vocabulary, "doc_id", "text").collect()
    assert len(got) == len(rows) and all(r.decoded == (r.text or "") for r in got)
    assert {r.doc_id: len(r.ids) for r in coded.collect() if r.doc_id in (1, 2)} == {1: 0, 2: 0}
    assert pieces.encode(df.limit(0), vocabulary).count() == 0
    with np.testing.assert_raises(OSError):
        pieces.load("/nowhere/x.model")

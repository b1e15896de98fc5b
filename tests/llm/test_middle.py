"""Fill-in-middle against a plain version, with texts in many pieces."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from prefloom.llm import middle
from prefloom.llm.queries import QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKS = ("<P>", "<S>", "<M>")


def plain_version(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, mid, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return doc_id, len(units), "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return [(v is not None, v) for v in row]


def compare(df, rows):
    want = [plain_version(*r) for r in rows]
    texts = sorted((tuple(r) for r in middle.transformed(df).collect()), key=key)
    assert texts == sorted(want, key=key)
    got = sorted((tuple(r) for r in middle.middle_report(df).collect()), key=key)
    assert got == sorted(((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows)), key=key)


@pytest.fixture
def small(monkeypatch):
    for name, value in {"UNITS": 3, "PIECE": 7, "BATCH": 100}.items():
        monkeypatch.setattr(middle, name, value)


def rows():
    rng = random.Random(7)
    words = ["a", "<P", "P>", "<", ">", "S>", "<S", "<M", "é", "中文字", " ", "\t", "\n\n", "　", "\x1f", "word", "😀" * 9]
    texts = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(60))) for _ in range(120)]
    texts += ["", None, " ", "\n", "x", "<M> in text", "x" * 500, "é" * 300 + " " + "y" * 40, " " * 50]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (3, "same id"), (3, "same id"), (-5, None)]


def test_forms_and_texts_in_small_pieces(spark, small):
    data = rows()
    compare(spark.createDataFrame(data, "doc_id long, text string").repartition(5), data)
    assert {plain_version(*r)[2] for r in data} == {"plain", "psm", "spm"}


def test_very_long_text_and_clashing_columns(spark):
    data = [(i, t) for i in range(6) for t in ("ab cd " * 200_000, "中" * 400_000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for name in ("rid", "place", "part", "at", "n", "form", "data", "output"):
        df = df.withColumn(name, df["doc_id"].cast("string"))
    compare(df, data)


def test_rates(spark):
    df = spark.createDataFrame([(i, f"a b c {i}") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in middle.transformed(df, rate=100, spm_rate=100).collect()} == {"spm"}
    assert {r.form for r in middle.transformed(df, rate=0).collect()} == {"plain"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert middle.middle_report(df).collect() == [] and middle.transformed(df).collect() == []


def test_one_shuffle(spark, sf_dir):
    plan = QUERIES["op11_fill_middle"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_bytes_of_ordinary_texts_are_not_sorted_again():
    texts = pa.array([f"word {i} " * 300 for i in range(200)])
    emitted = middle._emitted(range(200), range(200), texts, 42, 50, 80)
    batches = list(middle._batches(emitted, middle.PIECES, len(middle.PIECES) - 1))
    size = sum(batch["data"].nbytes for batch in middle._to_parts(iter(batches)))
    assert size < 200 * 100 < sum(batch["data"].nbytes for batch in batches)


@pytest.mark.parametrize("held", [0, 60])
def test_texts_beyond_what_is_held(spark, small, monkeypatch, held):
    monkeypatch.setattr(middle, "HELD", held)
    data = rows()
    compare(spark.createDataFrame(data, "doc_id long, text string").repartition(3), data)

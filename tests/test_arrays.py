"""Array files in byte ranges, and the place of their first error, against Python's reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from prefloom.functions.json_place import json_error
from prefloom.sources import arrays
from conftest import rows


@pytest.fixture
def files(tmp_path):
    def write(**texts):
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text, encoding="utf-8", newline="")
        return str(tmp_path)

    return write


@pytest.fixture
def ranges(spark):
    """Byte ranges of a given size."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_size
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def python_error(text):
    try:
        json.loads(text)
    except json.JSONDecodeError as e:
        return e.pos, e.msg, e.lineno, e.colno
    return None


def record(rng, i):
    text = rng.choice(["x}y", 'a"}{[', "plain", "\\", "中\n文 é", '\\"}', "]", ","]) * rng.randrange(4)
    return {"id": i, "t": text, "n": rng.choice([None, [1, {"z": {}}], {"q": [{}]}, 1.5e3])}


def mutated(rng, text):
    for _ in range(rng.randrange(1, 3)):
        k = rng.randrange(len(text) + 1)
        text = text[:k] + rng.choice(['"', "}", "{", ",", "x", "\n", "", "]", "[", "\\", "\t", "01", ":"]) + text[k + rng.randrange(2) :]
    return text


def corpus(seed, n):
    rng = random.Random(seed)
    texts = {}
    for k in range(n):
        data = [record(rng, i) for i in range(rng.randrange(12))]
        text = json.dumps(data, ensure_ascii=rng.random() < 0.3, indent=rng.choice([None, None, 1]))
        texts[f"f{k:03d}"] = mutated(rng, text) if rng.random() < 0.5 else text
    return texts | {"g0": "", "g1": " \n", "g2": "[]", "g3": " [ ]\n", "g4": "[1,", "g5": "[", "g6": '[{"a":1}', "g7": '[{"a":1}]]'}


def test_error_places_are_those_of_python(spark):
    rng = random.Random(3)
    tokens = ["{", "}", "[", "]", ":", ",", '"a"', '"b', '"', " ", "\n", "1", "01", "-", "1.5e3", "1.", "true", "nul", "NaN"]
    tokens += ["-Infinity", "\\n", "\\u12", "\\u00e9", '"\\x"', "é", "\t", '"k": ', '{"a": 1}', ", ", '"\x01"', "\x02", "\\"]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randrange(9))) for _ in range(1500)]
    texts += [mutated(rng, json.dumps([record(rng, 1)], indent=rng.choice([None, 1]))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", json_error(F.col("t")).alias("e")).collect()
    for r in found:
        expected = python_error(texts[r.i])
        assert (tuple(r.e) if r.e else None) == (expected and expected[:2]), texts[r.i]
    assert sum(r.e is None for r in found) > 100


def test_context_of_a_text(spark):
    df = spark.createDataFrame([(1, '{"a": 1,\n "b": 2,\n "c": oops,\n "d": 4\n}'), (2, '{"a": 1}'), (3, None), (4, "")], "i int, t string")
    found = {r.i: r.error for r in arrays.with_json_error(df, "t").collect()}
    assert found[2] is None
    assert (found[1].message, found[1].line, found[1].column) == ("Expecting value", 3, 7)
    assert [(c.line, c.text) for c in found[1].context] == [(1, '{"a": 1,'), (2, ' "b": 2,'), (3, ' "c": oops,'), (4, ' "d": 4'), (5, "}")]
    assert (found[4].message, found[4].line, found[4].column) == ("Expecting value", 1, 1)
    assert found[3] is None or found[3].message is None


@pytest.mark.parametrize("seed, size", [(1, 37), (2, 111), (4, 111), (3, 4000)])
def test_files_in_ranges(spark, files, ranges, seed, size):
    texts = corpus(seed, 24)
    path = files(**texts)
    ranges(size)
    good, bad = [], {}
    for name, text in sorted(texts.items()):
        error = python_error(text)
        if error is None:
            good += [x["id"] for x in json.loads(text)]
        elif text.strip():
            lines = text.split("\n")
            near = range(max(1, error[2] - 2), min(len(lines), error[2] + 2) + 1)
            # an empty line at the very end is none
            bad[name] = (*error[1:], [(n, lines[n - 1]) for n in near if n < len(lines) or lines[n - 1]])
    got = arrays.ingest_array_ranges(spark, path, {"id": "bigint"}, skip_bad=True)
    assert rows(got) == list(enumerate(good))
    found = {
        r.file.rsplit("/", 1)[-1].removesuffix(".json"): (r.message, r.line, r.column, [(c.line, c.text) for c in r.context or []])
        for r in arrays.array_rejects(spark, path).collect()
    }
    assert found == bad


def test_one_file_is_read_by_several_tasks(spark, files, ranges):
    data = [{"id": i, "text": "}{ " * 20, "more": {"k": [i]}} for i in range(2000)]
    path = files(one=json.dumps(data))
    ranges(20_000)
    pieces = arrays._read_pieces(spark, path)
    assert pieces.rdd.getNumPartitions() > 5
    assert pieces.select("range").distinct().count() > 5
    got = arrays.ingest_array_ranges(spark, path, {"id": "bigint", "text": "string", "more": "struct<k: array<bigint>>"})
    assert [(r.pos, r.id, r.text, r.more.k) for r in got.orderBy("pos").collect()] == [(i, i, "}{ " * 20, [i]) for i in range(2000)]


def test_a_record_longer_than_its_range(spark, files, ranges):
    data = [{"id": i, "text": "long } text \" " * 3000, "in": [{"a": {}}] * 200} for i in range(3)]
    path = files(one=json.dumps(data, indent=1))
    ranges(5_000)
    got = arrays.ingest_array_ranges(spark, path, {"id": "bigint", "text": "string"})
    assert [tuple(r) for r in got.orderBy("pos").collect()] == [(i, i, data[i]["text"]) for i in range(3)]


def test_bad_files_stop_the_job(spark, files):
    path = files(a='[{"id": 1}]', b='[{"id": oops}]')
    with pytest.raises(Exception, match="no JSON in .*b.json"):
        arrays.ingest_array_ranges(spark, path, {"id": "bigint"}).collect()


def test_absent_null_and_unfitting_fields(spark, files):
    path = files(a='[{"id":1,"r":["x"]},{"r":null},{"id":"three","r":"y"}]')
    got = arrays.ingest_array_ranges(spark, path, {"id": "int", "r": "array<string>"})
    assert rows(got) == [(0, 1, ["x"]), (1, None, None), (2, None, None)]


def test_numbered_lines(spark, files, ranges):
    path = files(a="\n".join(f"line {i}" for i in range(1, 400)), b="x\n\ny\n")
    ranges(100)
    found = rows(arrays.numbered_lines(spark, path).select(F.regexp_extract("file", r"(\w)\.json", 1), "number", "line"))
    assert found == [("a", i, f"line {i}") for i in range(1, 400)] + [("b", 1, "x"), ("b", 2, ""), ("b", 3, "y")]

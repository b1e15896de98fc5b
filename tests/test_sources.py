"""Record and question files in fresh folders."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from prefloom.registry import inputs, queries
from prefloom.sources import questions, records
from conftest import rows

ARRAY = (
    '[{"instruction":"甲","responses":["x","y"]},{"instruction":"b"},'
    '{"instruction":null,"responses":"notalist","more":{"k":1}}]'
)


@pytest.fixture
def files(tmp_path):
    def write(**texts):
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def names(df, *columns):
    return rows(df.withColumn("name", F.regexp_extract("file", r"(\w+)\.json$", 1)), "name", *columns)


def test_check_files(spark, files):
    path = files(
        whole=ARRAY, empty="", blank=" \n\n", none="[]", broken='[{"instruction":"a"},{"instruction": oops}]',
        cut='[{"instruction":"a"}',
    )
    assert names(records.check_files(spark, path), "status", "records") == [
        ("blank", "empty", 0), ("broken", "malformed", 0), ("cut", "malformed", 0), ("empty", "empty", 0),
        ("none", "ok", 0), ("whole", "ok", 3),
    ]


def test_absent_and_null_are_apart(spark, files):
    df = records.read_variants(spark, files(a=ARRAY), ["instruction", "responses"], "array").orderBy("line")
    flags = df.select(F.is_variant_null("instruction"), F.col("responses").isNull(), "corrupt").collect()
    assert [tuple(r) for r in flags] == [(False, False, None), (False, True, None), (True, False, None)]
    typed = records.typed(df, {"instruction": "string", "responses": "array<string>"})
    assert [tuple(r) for r in typed.select("instruction", "responses").collect()] == [
        ("甲", ["x", "y"]), ("b", None), (None, None)
    ]


def test_unknown_layout(spark, files):
    with pytest.raises(ValueError):
        records.read_variants(spark, files(a="[]"), ["x"], "table")


def test_list_position_over_files_and_splits(spark, files):
    expected, texts = [], {}
    for name in ("a", "b", "c"):
        lines = [json.dumps({"id": f"{name}{i}", "pad": "x" * 50}) for i in range(500)]
        expected += [f"{name}{i}" for i in range(500)]
        texts[name] = "\n".join(lines)
    path = files(**texts)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = records.ingest_records(spark, path, {"id": "string"}, partitions=5)
        assert rows(df) == list(enumerate(expected))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_list_position_in_an_array_file(spark, files):
    path = files(a=json.dumps([{"id": i} for i in range(300)]))
    assert rows(records.ingest_records(spark, path, {"id": "int"}, "array")) == [(i, i) for i in range(300)]


def test_stored_order(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    assert rows(records.read_snapshot(spark, path)) == [(i, i) for i in range(1000)]


def test_whole_lines_keep_unknown_keys(spark, files):
    df = records.read_whole_lines(spark, files(a='{"x":1,"y":{"z":[2]}}\nbad\n'))
    assert [r[0] for r in df.select(F.to_json("extra")).collect()] == ['{"x":1,"y":{"z":[2]}}', None]


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_bad_records_stop_the_job_or_are_told(spark, files, layout):
    path = files(a=ARRAY, b='[{"instruction": oops}]') if layout == "array" else files(a='{"id":1}\n{"id": oops}\n{"id":3}')
    types = {"instruction": "string"} if layout == "array" else {"id": "int"}
    with pytest.raises(Exception, match="no JSON in .*"):
        records.ingest_records(spark, path, types, layout)
    good = records.ingest_records(spark, path, types, layout, skip_bad=True)
    assert [r[0] for r in rows(good, "pos")] == list(range(3 if layout == "array" else 2))
    bad = records.read_rejects(spark, path, layout).collect()
    assert [(r["reason"], r["text"]) for r in bad] == [
        ("malformed_file", '[{"instruction": oops}]') if layout == "array" else ("malformed_line", '{"id": oops}')
    ]


def test_stored_order_of_many_parts(spark, tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    for n, name in enumerate(["part-99999-a", "part-100000-a", "part-100001-a"]):
        spark.range(n * 10, n * 10 + 10).coalesce(1).write.parquet(str(tmp_path / name))
        (part,) = (tmp_path / name).glob("*.parquet")
        (path / f"{name}.parquet").write_bytes(part.read_bytes())
    assert rows(records.read_snapshot(spark, str(path))) == [(i, i) for i in range(30)]


def test_a_range_opens_its_files_only(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).repartitionByRange(10, "id").sortWithinPartitions("id").write.parquet(path)
    starts = records.file_starts(spark, path)
    part = records.read_range(spark, starts, 950, 1000, spark.range(1).schema)
    assert rows(part) == [(i, i) for i in range(950, 1000)]
    assert len(part.inputFiles()) < 4
    assert records.read_range(spark, starts, 1000, 2000, spark.range(1).schema).count() == 0


def test_malformed_lines(spark, files):
    df = records.malformed_lines(spark, files(a='{"x":1}\n{"x": oops}\n\n{"x":2'))
    assert sorted(r["value"] for r in df.collect()) == ['{"x": oops}', '{"x":2']


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "out")
    assert not records.is_complete(spark, path)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "part-0.parquet").write_text("half")
    assert records.write_once(spark.range(3), path)
    assert not records.write_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_written_text_is_utf8_with_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    records.write_records(spark.createDataFrame([("中文", None)], "a string, b string"), path)
    assert spark.read.text(path).first()[0] == '{"a":"中文","b":null}'


def test_absent_table_reads_empty(spark, tmp_path):
    df = spark.range(1)
    assert records.read_if_present(spark, str(tmp_path / "none"), df.schema).count() == 0


LETTERS = {"A": "1", "B": "2", "C": "3", "D": "4"}


def test_question_list(spark, files):
    data = [
        {"subject": "s", "Question": "q", "Answer": "A", **LETTERS},
        {"Question": "q2", "Answer": "B", **LETTERS, "D": None},
        {"subject": "s", "Question": "", "Answer": "A", **LETTERS},
        {"subject": "s", "Question": "q", "Answer": "A", "A": "1"},
        {"subject": "s", "question": "q", "Answer": "A", **LETTERS},
        {"subject": "s", "Question": "q", "Answer": None, **LETTERS},
    ]
    df = questions.read_choice_questions(spark, files(a=json.dumps(data)))
    assert rows(df) == [(0, "s", "q", ["1", "2", "3", "4"], "A"), (1, "", "q2", ["1", "2", "3", None], "B")]


def test_question_data_object(spark, files):
    data = {"data": [
        {"category": "c", "question": "q", "answer": "A", "options": ["x", "y"]},
        {"question": "q", "answer": "B", **LETTERS, "options": ["ignored"]},
        {"subject": "s", "category": "c", "question": "q", "answer": "B", "options": []},
        {"subject": "s", "category": "c", "question": 0, "answer": "B", **LETTERS},
        {"subject": "s", "category": "c", "question": "q", "answer": "B", "options": "xy"},
    ]}
    df = questions.read_choice_questions(spark, files(a=json.dumps(data)))
    assert rows(df) == [(0, "c", "q", ["x", "y"], "A"), (1, "default", "q", ["1", "2", "3", "4"], "B")]


def test_question_subjects(spark, files):
    item = {"question": "q", "answer": "A"}
    data = {"two": [{**item, **LETTERS}, {**item, "options": ["x"]}], "one": [{**item, **LETTERS}], "note": "text"}
    df = questions.read_choice_questions(spark, files(a=json.dumps(data)))
    got = [(r["subject"], r["options"]) for r in df.orderBy("subject", "pos").collect()]
    assert got == [("one", ["1", "2", "3", "4"]), ("two", ["1", "2", "3", "4"]), ("two", ["x"])]


@pytest.mark.parametrize("text", ['"text"', "3"])
def test_unknown_question_shape(spark, files, text):
    with pytest.raises(ValueError):
        questions.read_choice_questions(spark, files(a=text))


def test_positions_over_files_and_subjects(spark, files):
    item = {"answer": "A", **LETTERS}
    data = {s: [{"question": f"{s}{i}", **item} for i in range(300)] for s in ("two", "one")}
    df = questions.read_choice_questions(spark, files(a=json.dumps(data), b=json.dumps(data)))
    got = rows(df, "pos", "subject", "question")
    expected = [(s, f"{s}{i}") for _ in "ab" for s in ("one", "two") for i in range(300)]
    assert got == [(i, *e) for i, e in enumerate(expected)]


@pytest.mark.parametrize("shape", ["list", "data", "keyed"])
def test_question_files_are_bounded(spark, tmp_path, shape):
    """More questions make more files, not longer ones; the order stays that of the copies."""
    n = 2 * queries.QUESTION_ROWS + 50
    items = [(i, f"text number {i} of the benchmark") for i in range(n)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    path = queries._question_files(spark, str(tmp_path), shape)
    held = [json.loads(f.read_text()) for f in Path(path.removeprefix("file:")).rglob("part-*")]
    sizes = [len(x) if shape == "list" else sum(map(len, x.values())) for x in held]
    assert sum(sizes) == queries.COPIES * n and max(sizes) <= queries.QUESTION_ROWS
    got = questions.read_choice_questions(spark, path).orderBy("pos").collect()
    asked = [r for r in inputs.questions(spark, str(tmp_path)).collect() if r.question]
    order = [(c % 2, r.subject if shape == "keyed" else "", c, r.pos, r.question) for c in range(queries.COPIES) for r in asked]
    assert [(r.pos, r.question) for r in got] == [(i, x[-1]) for i, x in enumerate(sorted(order))]

"""Whole flows with stub models, and the shape of their plans."""

import re
import threading
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from prefloom.plans import choice, judging, preference, splitting, training
from conftest import rows


def make(responder):
    return lambda: responder


def numbered(prompts, seeds):
    return [f" answer {s % 4} " for s in seeds]


def ranker(prompts, seeds):
    return ["排名：4 > 1 > 2 > 3"] * len(prompts)


def judge(prompts, seeds):
    if any("fail" in p for p in prompts):
        raise RuntimeError("busy")
    return ["<score>9</score>"] * len(prompts)


def refuse(prompts, seeds):
    raise AssertionError("nothing may be asked")


def failing(prompts, seeds):
    if any("q3" in p for p in prompts):
        raise RuntimeError("busy")
    return numbered(prompts, seeds)


def test_failed_rows_are_rejects(spark, tmp_path):
    for generate in (judging.generate_responses, preference.generate_candidates):
        made = generate(instruction_rows(spark, 5), str(tmp_path / generate.__name__), make(failing))
        assert rows(made.rows, "pos") == [(0,), (1,), (2,), (4,)]
        assert rows(made.rejects) == [(3, "error: busy")]


def test_failed_choices_are_no_wrong_answers(spark, tmp_path):
    questions = spark.createDataFrame(
        [(i, "x", f"q{i}", ["a", "b"], "A") for i in range(5)],
        "pos bigint, subject string, question string, options array<string>, answer string",
    )

    def busy(prompts, seeds):
        if any("q3" in p for p in prompts):
            raise RuntimeError("busy")
        return ["A"] * len(prompts)

    result = choice.evaluate_choices(questions, ["x"], str(tmp_path / "graded"), make(busy))
    assert rows(result.failed, "pos", "status") == [(3, "error: busy")]
    assert rows(result.accuracy.filter("subject = 'x'"), "correct", "samples") == [(4, 4)]


def test_counts_wait_for_the_rows(spark):
    for cap in (2, 20_000):
        ranked = spark.createDataFrame(
            [(i, "a", [0, 1], ["x", "y"]) for i in range(5)],
            "pos bigint, instruction string, sorted_indices array<bigint>, responses array<string>",
        )
        pairs = preference.training_pairs(ranked.withColumn("input", F.lit("")), cap)
        threading.Timer(0.5, lambda df=pairs.rows: df.count()).start()
        start = time.monotonic()
        assert pairs.counts.get == {"raw": 5, "cleaned": 5}
        assert time.monotonic() - start > 0.3


def letter(prompts, seeds):
    return ["B" if "two" in p else "答案：A" for p in prompts]


def words(texts):
    return [[len(w) for w in text.split()] for text in texts]


def instruction_rows(spark, n=20):
    return spark.range(n).select(
        F.col("id").alias("pos"), F.concat(F.lit("q"), "id").alias("instruction"),
        F.when(F.col("id") % 2 == 0, "").otherwise("ctx").alias("input"), F.lit("gold").alias("output"),
    )


def test_from_instructions_to_pairs(spark, tmp_path):
    asked = instruction_rows(spark).unionByName(instruction_rows(spark, 1).selectExpr("99L AS pos", "CAST(NULL AS STRING) AS instruction", "input", "output"))
    made = preference.generate_candidates(asked, str(tmp_path / "candidates"), make(numbered))
    candidates = made.rows
    assert rows(made.rejects) == [(99, "null_instruction")]
    assert candidates.columns == ["pos", "instruction", "input", "ground_truth", "responses"]
    ranked = preference.rank_candidates(candidates, str(tmp_path / "ranked"), 0, make(ranker))
    pairs = preference.training_pairs(ranked, max_samples=15, keep=("pos",))
    got = rows(pairs.rows)
    assert [r[0] for r in got] == list(range(15))
    by_pos = {r["pos"]: r["responses"] for r in candidates.collect()}
    assert all((r[2], r[3]) == (by_pos[r[0]][3], by_pos[r[0]][2]) for r in got)
    assert all(len(set(x)) == 4 and not x[0].startswith(" ") for x in by_pos.values())


def test_judging(spark, tmp_path):
    made = judging.generate_responses(instruction_rows(spark, 6), str(tmp_path / "responses"), make(numbered))
    responses = made.rows
    assert made.rejects.count() == 0
    records = responses.select(
        "pos", *[
            F.try_variant_get(F.parse_json(F.to_json(F.struct(F.col(c).alias("x")))), "$.x", "variant").alias(c)
            for c in ("instruction", "ground_truth", "response")
        ],
    )
    records = records.withColumn("response", F.when(F.col("pos") != 5, F.col("response"))).withColumn(
        "instruction", F.when(F.col("pos") == 2, F.parse_json(F.lit('"fail"'))).otherwise(F.col("instruction"))
    )
    out = str(tmp_path / "judged")
    result = judging.judge_records(records, out, make(judge))
    assert rows(result.rejects) == [(5, "missing_response")]
    assert tuple(result.summary.first()) == (5, 4, 1, 9.0)
    assert rows(result.scores.filter("score = 0"), "pos", "judge_response", "status") == [
        (2, "[ERROR: busy]", "error: busy")
    ]
    again = judging.judge_records(records, out, make(refuse))
    assert again.statistics.first()["average_score"] == 9.0


def test_choices(spark, tmp_path):
    questions = spark.createDataFrame(
        [(i, s, f"{'one' if i % 3 else 'two'} {i}", ["a", "b"], "B") for i, s in enumerate(["x", "y", "z"] * 5)],
        "pos bigint, subject string, question string, options array<string>, answer string",
    )
    out = str(tmp_path / "graded")
    result = choice.evaluate_choices(questions, ["y", "x", "none"], out, make(letter), limit=4, every=2)
    assert rows(result.accuracy.fillna("all"), "subject", "correct", "samples") == [("all", 4, 8), ("x", 4, 4), ("y", 0, 4)]
    assert rows(result.listed) == [
        (1, "cmmlu:y", 0.0, 0.0), (2, "cmmlu:x", 1.0, 0.0), (3, "cmmlu:none", 0.0, 0.0)
    ]
    assert rows(result.running) == [("x", 2, 2, 1.0), ("x", 4, 4, 1.0), ("y", 2, 0, 0.0), ("y", 4, 0, 0.0)]
    assert rows(result.details, "subject", "question_id") == [(s, i) for s in "xy" for i in range(1, 5)]


def test_supervised(spark):
    batches = training.supervised_batches(instruction_rows(spark, 5), make(words), 2, 0)
    assert [r[:2] for r in rows(batches, "pos", "batch")] == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]


# --- plans


def test_token_arrays_cross_one_exchange(spark, sf_dir):
    df = entry.queries()["padded_batches"](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    wide = [part for part in text.split("Exchange hashpartitioning")[1:] if "input_ids#" in part.split("Exchange")[0] and "size(" not in part.split("Exchange")[0]]
    assert len(wide) <= 1  # none where the places are few enough to be broadcast
    assert "Python" not in text and "InArrow" not in text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["judge_score", "judge_stats", "dpo_pairs", "mcq_limit", "mcq_details", "rank_pending",
                                  "rank_upsert", "dense_position", "split_train", "render_chat", "mcq_running"])
def test_plan_shape(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "Python" not in text and "InArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a window never runs over the rows of a whole table or group: it is inside a
    # block, inside a span of blocks, or over the totals of the widest spans
    for line in re.findall(r"Window \[.*", text):
        assert "_block" in line, line


def test_split_reaches_the_scan(spark):
    text = plan(entry.queries()["split_preference"](spark, "/root/testdata/sf0.01"))
    assert "Exchange" not in text and "Window" not in text
    assert "GreaterThanOrEqual(doc_id" in text and "LessThan(doc_id" in text


def test_judging_reads_needed_columns_only(spark, sf_dir):
    text = plan(entry.queries()["judge_stats"](spark, sf_dir))
    assert "role" not in text
    assert text.count("Exchange") == 1


def test_position_zip_and_snapshot_do_not_sort_the_table(spark, sf_dir):
    text = plan(entry.queries()["snapshot_position"](spark, sf_dir))
    # one shuffle, of the row counts per file; the rows themselves stay where they are
    (shuffle,) = re.findall(r"Exchange hashpartitioning.*\n.*", text)
    assert "partial_count" in shuffle
    assert "SortMergeJoin" not in text


def test_split_of_a_stored_table(spark, tmp_path):
    table, out = str(tmp_path / "table"), str(tmp_path / "parts")
    rows_ = spark.range(1000).selectExpr("id", "concat('q', id) AS instruction")
    rows_.repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(table)
    parts = splitting.split_snapshot(spark, table, out, train=100, preference=50, evaluation=20)
    got = {n: [r[0] for r in rows(p, "id")] for n, p in parts.items()}
    assert got == {
        "train": list(range(100)), "preference": list(range(930, 980)), "evaluation": list(range(980, 1000))
    }
    assert rows(parts["evaluation"], "pos") == [(i,) for i in range(980, 1000)]

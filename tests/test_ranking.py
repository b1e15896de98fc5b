"""Resumed ranking runs, in batch and as a stream."""

import pytest

from prefloom.streaming import ranking
from conftest import rows


def make(responder):
    return lambda: responder


def only_short(prompts, seeds):
    return ["排名：2 > 1" if "long" not in p else "?" for p in prompts]


def always(prompts, seeds):
    return ["排名：1 > 2"] * len(prompts)


def refuse(prompts, seeds):
    raise AssertionError("nothing may be asked")


def candidates(spark, *instructions, start=0):
    data = [(start + i, t, "", "", ["x", "y"]) for i, t in enumerate(instructions)]
    return spark.createDataFrame(
        data, "pos bigint, instruction string, input string, ground_truth string, responses array<string>"
    )


def state(spark, path, batch):
    return rows(ranking.read_results(spark, path, batch), "instruction", "pos", "batch", "sorted_indices")


def test_runs_resume(spark, tmp_path):
    path = str(tmp_path / "results")
    df = candidates(spark, "a", "long b", "a", None, "long b")
    assert state(spark, path, 0) == []
    ranking.rank_run(df, path, 0, make(only_short))
    assert state(spark, path, 0) == [("a", 2, 0, [1, 0]), ("long b", 4, 0, None)]
    ranking.rank_run(df, path, 1, make(always))
    assert state(spark, path, 1) == [("a", 2, 0, [1, 0]), ("long b", 4, 1, [0, 1])]
    asked = rows(ranking.read_runs(spark, path).filter("batch = 1"), "instruction")
    assert asked == [("long b",), ("long b",)]
    ranking.rank_run(df, path, 2, make(refuse))
    assert state(spark, path, 2) == [("a", 2, 0, [1, 0]), ("long b", 4, 1, [0, 1])]


def test_a_run_that_is_repeated_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "results")
    df = candidates(spark, "a", "long b")
    ranking.rank_run(df, path, 0, make(only_short))
    ranking.rank_run(df, path, 0, make(always))
    assert state(spark, path, 0) == [("a", 0, 0, [0, 1]), ("long b", 1, 0, [0, 1])]


def test_earlier_failures_leave_the_state(spark, tmp_path):
    path = str(tmp_path / "results")
    ranking.rank_run(candidates(spark, "long a"), path, 0, make(only_short))
    ranking.rank_run(candidates(spark, "b", start=5), path, 1, make(only_short))
    assert state(spark, path, 1) == [("b", 5, 1, [1, 0])]


def test_stream_takes_new_files_only(spark, tmp_path):
    arriving, path, checkpoint = (str(tmp_path / n) for n in ("in", "results", "state"))
    df = candidates(spark, "a", "long b")

    def start(responder):
        ranking.rank_stream(
            spark, arriving, df.schema, path, checkpoint, make(responder)
        ).awaitTermination()

    df.write.parquet(arriving)
    start(only_short)
    assert state(spark, path, 0) == [("a", 0, 0, [1, 0]), ("long b", 1, 0, None)]
    start(refuse)
    candidates(spark, "a", "long b", "c", start=10).write.mode("append").parquet(arriving)
    start(always)
    last = max(r["batch"] for r in ranking.read_runs(spark, path).collect())
    assert state(spark, path, last) == [
        ("a", 0, 0, [1, 0]), ("c", 12, last, [0, 1]), ("long b", 11, last, [0, 1])
    ]


def test_one_start_of_many_batches_has_all_rows(spark, tmp_path):
    arriving, path, checkpoint = (str(tmp_path / n) for n in ("in", "results", "state"))
    df = candidates(spark, *[f"t{i}" for i in range(40)])
    df.repartition(4, "instruction").write.parquet(arriving)
    ranking.rank_stream(spark, arriving, df.schema, path, checkpoint, make(always), max_files=1).awaitTermination()
    assert ranking.read_runs(spark, path).select("batch").distinct().count() >= 3
    assert rows(ranking.read_results(spark, path), "instruction") == sorted((f"t{i}",) for i in range(40))


@pytest.mark.parametrize("keys, left", [(("instruction",), 1), (("instruction", "input"), 1)])
def test_key_columns(spark, tmp_path, keys, left):
    path = str(tmp_path / "results")
    ranking.rank_run(candidates(spark, "a"), path, 0, make(always), key_cols=keys)
    ranking.rank_run(candidates(spark, "a", "b", start=3), path, 1, make(always), key_cols=keys)
    assert ranking.read_runs(spark, path).filter("batch = 1").count() == left

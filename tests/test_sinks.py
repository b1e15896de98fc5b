"""Array files written in order, results with a manifest, and rows dealt by cost."""

import json
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from prefloom.operators import completion
from prefloom.sources import arrays, records
from conftest import ROOT, rows


def written(path):
    files = sorted(Path(path).rglob("part-*"), key=str)
    return [json.loads(f.read_text(encoding="utf-8")) for f in files]


def table(spark, n):
    return spark.range(n).select((F.col("id") * 3 + 5).alias("pos"), F.concat(F.lit('中\n"'), "id").alias("text"), F.lit(None).cast("int").alias("none"))


@pytest.mark.parametrize("n, size", [(1, 10), (10, 10), (25, 10), (25, 1), (300, 1 << 20)])
def test_files_are_lists_in_order(spark, tmp_path, n, size):
    path = str(tmp_path / "out")
    arrays.write_array(table(spark, n).repartition(4), path, file_rows=size)
    lists = written(path)
    assert [len(x) for x in lists] == [min(size, n - k) for k in range(0, n, size)]
    assert [x for part in lists for x in part] == [{"pos": 3 * i + 5, "text": f'中\n"{i}', "none": None} for i in range(n)]


def test_written_files_are_read_back_in_ranges(spark, tmp_path):
    path = str(tmp_path / "out")
    arrays.write_array(table(spark, 25), path, file_rows=10)
    back = arrays.ingest_array_ranges(spark, path, {"text": "string", "none": "int"})
    assert rows(back) == [(i, f'中\n"{i}', None) for i in range(25)]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    arrays.write_array(table(spark, 0), path)
    assert written(path) == [] and records.is_complete(spark, path)


def test_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(2, "b", "x"), (1, "a", "y")], "pos bigint, file string, value string")
    arrays.write_array(df, path)
    assert written(path) == [[{"pos": 1, "file": "a", "value": "y"}, {"pos": 2, "file": "b", "value": "x"}]]


def test_a_failed_write_leaves_no_result_and_is_repeated(spark, tmp_path):
    path = str(tmp_path / "out")
    broken = table(spark, 50).withColumn("none", F.when(F.col("pos") > 100, F.raise_error(F.lit("broken row")).cast("int")))
    with pytest.raises(Exception, match="broken row"):
        arrays.write_array(broken, path, file_rows=10)
    assert not records.is_complete(spark, path) and written(path) == []
    arrays.write_array(table(spark, 50), path, file_rows=10, mode="overwrite")
    assert sum(map(len, written(path))) == 50


def test_a_failed_attempt_of_a_task_is_discarded(tmp_path):
    """A session of its own, in which tasks may be tried again."""
    program = f"""
    import sys; sys.path.insert(0, {str(ROOT)!r})
    import __spark_entry__
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from prefloom.sources import arrays, records
    spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()

    def once(batches):
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("first attempt")
        yield from batches

    df = spark.range(100).withColumnRenamed("id", "pos")
    number, arrays.number_rows = arrays.number_rows, lambda *a, **k: number(*a, **k).repartition(3).mapInArrow(once, "_key bigint, _record string, _place bigint")
    arrays.write_array(df, {str(tmp_path / 'out')!r}, file_rows=30)
    assert records.is_complete(spark, {str(tmp_path / 'out')!r})
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(program)], capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [[x["pos"] for x in part] for part in written(tmp_path / "out")] == [list(range(k, min(k + 30, 100))) for k in range(0, 100, 30)]


def test_manifest_follows_inputs_and_parameters(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).coalesce(1).write.parquet(source)

    def write(**parameters):
        return records.write_manifested(spark.read.parquet(source), out, source, **parameters)

    assert write(n=1) and not write(n=1)
    assert write(n=2) and not write(n=2)
    spark.range(3).coalesce(1).write.mode("append").parquet(source)
    assert write(n=2)
    assert spark.read.parquet(out).count() == 8 and not write(n=2)
    # a result whose write was cut off has no manifest
    records.delete_path(spark, f"{out}.manifest/_SUCCESS")
    assert write(n=2) and not write(n=2)


def test_tasks_of_equal_cost(spark):
    df = spark.range(5000).select(
        F.col("id").alias("pos"), F.expr("repeat('x', cast(CASE WHEN id < 500 THEN 400 ELSE id % 40 END AS int))").alias("prompt")
    )
    dealt = completion.balanced(df, F.length("prompt") + 1, 12)
    costs = rows(dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.length("prompt") + 1), F.count(F.lit(1))))
    assert len(costs) == 12 and sum(c[2] for c in costs) == 5000
    mean = sum(c[1] for c in costs) / 12
    assert max(c[1] for c in costs) <= 1.2 * mean and max(c[2] for c in costs) > 3 * min(c[2] for c in costs)
    # rows of like length follow each other
    for _, batch in dealt.select(F.spark_partition_id().alias("p"), F.length("prompt").alias("n")).toPandas().groupby("p"):
        assert batch["n"].is_monotonic_increasing


def test_balanced_completion_answers_every_row(spark):
    df = spark.createDataFrame([(i, "p" * (i % 7) if i % 5 else None) for i in range(40)], "pos bigint, prompt string")
    done = completion.complete_balanced(df.filter("prompt IS NOT NULL"), "prompt", lambda: lambda p, s: [x.upper() for x in p], 5, batch_size=3)
    assert rows(done, "pos", "response") == [(i, "P" * (i % 7)) for i in range(40) if i % 5]
    assert completion.complete_balanced(df.limit(0), "prompt", lambda: lambda p, s: p, 5).count() == 0

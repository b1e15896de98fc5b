"""Batch completion with pure-function responders."""

from pyspark.sql import functions as F

from prefloom.operators.completion import complete, spread
from conftest import rows


def make(responder):
    return lambda: responder


def upper(prompts, seeds):
    return [p.upper() for p in prompts]


def picky(prompts, seeds):
    if any("bad" in p for p in prompts):
        raise ValueError("no")
    return upper(prompts, seeds)


def short(prompts, seeds):
    return prompts[:1]


def silent(prompts, seeds):
    return [None] * len(prompts)


def seeded(prompts, seeds):
    return [str(s) for s in seeds]


def asked(spark, *prompts):
    return spark.createDataFrame([(i, p, [p]) for i, p in enumerate(prompts)], "pos bigint, prompt string, extra array<string>")


def test_rows_travel_with_their_text(spark):
    done = complete(asked(spark, "a", "b", "c"), "prompt", make(upper), batch_size=2)
    assert rows(done, "pos", "extra", "response", "status") == [
        (0, ["a"], "A", "success"), (1, ["b"], "B", "success"), (2, ["c"], "C", "success")
    ]


def test_one_failure_spares_its_batch(spark):
    done = complete(asked(spark, "a", "bad", "c").coalesce(1), "prompt", make(picky))
    assert rows(done, "response", "status") == [
        (None, "error: no"), ("A", "success"), ("C", "success")
    ]


def test_wrong_number_of_texts(spark):
    done = complete(asked(spark, "a", "b", "c").coalesce(1), "prompt", make(short))
    assert [r["response"] for r in done.orderBy("pos").collect()] == ["a", "b", "c"]


def test_no_text_is_an_error(spark):
    done = complete(asked(spark, "a"), "prompt", make(silent))
    assert [tuple(r) for r in done.select("response", "status").collect()] == [(None, "error: no reply")]


def test_samples_differ_and_repeat(spark):
    many = spark.range(500).select(F.col("id").alias("pos"), F.lit("p").alias("prompt"))
    first = complete(many, "prompt", make(seeded), out="texts", k=4)
    again = complete(spread(many, 3), "prompt", make(seeded), out="texts", k=4, batch_size=7)
    assert rows(first, "pos", "texts") == rows(again, "pos", "texts")
    texts = [r["texts"] for r in first.collect()]
    assert all(len(set(t)) == 4 for t in texts)
    assert len({t[0] for t in texts}) > 490
    other = complete(many, "prompt", make(seeded), out="texts", k=4, seed=7)
    assert rows(other, "texts") != rows(first, "texts")


def test_partitions(spark):
    many = spark.range(100).select(F.col("id").alias("pos"), F.lit("p").alias("prompt")).coalesce(1)
    done = complete(spread(many, 6), "prompt", make(upper), keep_prompt=False)
    assert done.count() == 100
    assert done.columns == ["pos", "response", "status"]
    assert done.rdd.getNumPartitions() == 6

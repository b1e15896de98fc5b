"""Judge scores: stored summaries recomputed, and edge cases."""

import json

import pytest

from prefloom.operators import judging
from prefloom.operators.choice import accuracy, accuracy_document, listed_accuracy
from conftest import rows

# Published results as counts of the scores 1..10, failed calls and
# (success rate, mean, upper median, bands, variance, standard deviation).
PUBLISHED = {
    "baseline": (
        [9, 32, 19, 23, 37, 31, 35, 56, 140, 116], 2,
        (99.6, 7.44, 9.0, [256, 56, 35, 31, 83], 6.7807, 2.604),
    ),
    "tuned": (
        [9, 27, 30, 22, 16, 26, 37, 54, 150, 129], 0,
        (100.0, 7.62, 9.0, [279, 54, 37, 26, 88], 6.7845, 2.6047),
    ),
    "aligned": (
        [4, 22, 32, 24, 18, 31, 27, 46, 140, 155], 1,
        (99.8, 7.78, 9.0, [295, 46, 27, 31, 82], 6.4553, 2.5407),
    ),
}
# Correct answers of 100 per subject and the overall accuracy.
CHOICES = {
    "baseline": ([66, 32, 48, 61, 74], 0.562),
    "tuned": ([70, 36, 52, 70, 67], 0.59),
    "aligned": ([69, 32, 52, 70, 67], 0.58),
}
SUBJECTS = ["s1", "s2", "s3", "s4", "s5"]


def scored(spark, counts, failed):
    data = [(float(s), "success") for s, n in enumerate(counts, 1) for _ in range(n)]
    return spark.createDataFrame(data + [(0.0, "error: x")] * failed, "score double, status string").repartition(7)


@pytest.mark.parametrize("name", PUBLISHED)
def test_published_statistics(spark, name):
    counts, failed, (rate, mean, median, bands, variance, deviation) = PUBLISHED[name]
    df = scored(spark, counts, failed)
    ok = sum(counts)
    assert tuple(judging.judge_stats(df).first()) == (
        500, ok, failed, rate, mean, 10.0, 1.0, median, variance, deviation,
    )
    assert [r[2] for r in rows(judging.judge_distribution(df))] == bands
    assert [r[2] for r in rows(judging.judge_distribution(df, with_gap_bucket=True))][4] == counts[4]
    assert tuple(judging.judge_summary(df).first()) == (500, ok, failed, mean)


@pytest.mark.parametrize("name", CHOICES)
def test_published_accuracy(spark, name):
    correct, overall = CHOICES[name]
    data = [(s, i < n) for s, n in zip(SUBJECTS, correct) for i in range(100)]
    acc = accuracy(spark.createDataFrame(data, "subject string, is_correct boolean"))
    by_subject = {r["subject"]: r["acc"] for r in acc.collect()}
    assert by_subject == {**{s: n / 100 for s, n in zip(SUBJECTS, correct)}, None: overall}
    document = json.loads(accuracy_document(acc, SUBJECTS).first()[0])
    assert list(document["results"]) == [
        *[f"cmmlu_{s}" for s in SUBJECTS], "cmmlu", *[f"cmmlu:{s}" for s in SUBJECTS]
    ]
    assert document["results"]["cmmlu"] == {"acc": overall, "samples": 500}
    assert document["results"]["cmmlu:s1"] == {"acc": correct[0] / 100, "acc_stderr": 0.0}
    assert document["versions"] == {"cmmlu_native": "1.0"} and document["config"] == {}


def test_accuracy_of_nothing(spark):
    acc = accuracy(spark.createDataFrame([], "subject string, is_correct boolean"))
    assert rows(acc, "is_total", "samples", "acc") == [(True, 0, 0.0)]
    assert rows(listed_accuracy(acc, ["a"])) == [(1, "cmmlu:a", 0.0, 0.0)]


def test_nothing_scored(spark):
    df = scored(spark, [0] * 10, 3)
    assert judging.judge_stats(df).count() == 0
    assert tuple(judging.judge_summary(df).first()) == (3, 0, 3, 0.0)
    assert [r[2:] for r in rows(judging.judge_distribution(df))] == [(0, 0.0)] * 5
    assert judging.statistics_document(df).count() == 0


def test_even_count_takes_the_upper_median(spark):
    df = scored(spark, [1, 1, 1, 1, 0, 0, 0, 0, 0, 0], 0)
    assert judging.judge_stats(df).first()["median_score"] == 3.0


def test_document(spark):
    counts, failed, _ = PUBLISHED["baseline"]
    document = json.loads(judging.statistics_document(scored(spark, counts, failed)).first()[0])
    assert document["summary"] == {
        "total_items": 500, "successful_evaluations": 498, "failed_evaluations": 2, "success_rate": 99.6
    }
    assert list(document["distribution"].items()) == [
        ("9-10分", 256), ("8-8.9分", 56), ("7-7.9分", 35), ("6-6.9分", 31), ("5分以下", 83)
    ]
    assert document["details"] == {"score_variance": 6.7807, "score_std_dev": 2.604}


def test_failed_calls_keep_their_error(spark):
    df = spark.createDataFrame(
        [(0, "<score>8.125</score>", "success"), (1, None, "error: error: timeout"), (2, None, "success")],
        "pos bigint, judge_response string, status string",
    )
    assert rows(judging.score_replies(df), "pos", "judge_response", "score", "status") == [
        (0, "<score>8.125</score>", 8.12, "success"),
        (1, "[ERROR: error: timeout]", 0.0, "error: error: timeout"),
        (2, "[ERROR: no reply]", 0.0, "error: no reply"),
    ]

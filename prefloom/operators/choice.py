"""Multiple-choice questions: selection, prompts, answers and accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import choice_prompt
from prefloom.functions.text import choice_letter, py_strip
from prefloom.operators.positions import first_rows, number_rows

# Fixed value: the name that leads the result keys.
TASK = "cmmlu"


def select_subjects(questions: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """Questions of the listed subjects, with the subject's place in the list."""
    listed = F.array(*[F.lit(s) for s in subjects])
    return questions.filter(F.col("subject").isin(list(subjects))).withColumn(
        "subject_no", F.array_position(listed, F.col("subject")).cast("int")
    )


def subject_counts(questions: DataFrame) -> DataFrame:
    return questions.groupBy("subject").agg(F.count(F.lit(1)).alias("questions"))


def limit_per_subject(questions: DataFrame, limit: int, key: str = "pos") -> DataFrame:
    return first_rows(questions, limit, key, ["subject"], "question_id")


def number_per_subject(questions: DataFrame, key: str = "pos") -> DataFrame:
    return number_rows(questions, key, ["subject"], "question_id", first=1)


def with_choice_prompt(questions: DataFrame, name: str = "prompt") -> DataFrame:
    return questions.withColumn(
        name, choice_prompt(F.col("subject"), F.col("question"), F.col("options"))
    )


def grade_answers(answered: DataFrame, output: str = "model_output") -> DataFrame:
    """Stripped output, predicted letter and whether it equals ``answer``."""
    letter = choice_letter(F.col(output))
    return answered.withColumns(
        {
            output: py_strip(F.col(output)),
            "predicted_answer": letter,
            "is_correct": F.coalesce(letter == F.col("answer"), F.lit(False)),
        }
    )


def _rate(correct: str, samples: str):
    return F.when(F.col(samples) > 0, F.col(correct) / F.col(samples)).otherwise(0.0)


def accuracy(graded: DataFrame) -> DataFrame:
    """Accuracy per subject and, with a NULL subject and ``is_total``, overall."""
    per_subject = graded.groupBy("subject").agg(
        F.count_if("is_correct").alias("correct"), F.count(F.lit(1)).alias("samples")
    )
    total = per_subject.agg(
        F.coalesce(F.sum("correct"), F.lit(0)).alias("correct"),
        F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"),
    ).select(F.lit(None).cast("string").alias("subject"), "correct", "samples", F.lit(True).alias("is_total"))
    rows = per_subject.withColumn("is_total", F.lit(False)).unionByName(total)
    return rows.select(
        "subject", "is_total", "correct", "samples", _rate("correct", "samples").alias("acc")
    )


def listed_accuracy(acc: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """One row per listed subject; 0.0 for a subject without questions."""
    listed = acc.sparkSession.createDataFrame(
        [(i, s) for i, s in enumerate(subjects, 1)], "subject_no int, subject string"
    )
    return listed.join(acc.filter(~F.col("is_total")), "subject", "left").select(
        "subject_no",
        F.concat(F.lit(f"{TASK}:"), "subject").alias("key"),
        F.coalesce("acc", F.lit(0.0)).alias("acc"),
        F.lit(0.0).alias("acc_stderr"),
    )


def running_accuracy(graded: DataFrame, every: int = 100, key: str = "pos") -> DataFrame:
    """Accuracy so far at every ``every``-th question of a subject."""
    narrow = graded.select("subject", key, F.col("is_correct").cast("int").alias("_hit"))
    numbered = number_rows(
        narrow, key, ["subject"], "question_id", first=1, running={"correct": F.col("_hit")}
    )
    return numbered.filter(F.col("question_id") % every == 0).select(
        "subject", "question_id", "correct", (F.col("correct") / F.col("question_id")).alias("acc")
    )


def answer_details(graded: DataFrame, output: str = "model_output") -> DataFrame:
    """One record per numbered and graded question."""
    return graded.select(
        "subject", "question_id", "question", "options", "prompt",
        F.col(output).alias("model_output"), "predicted_answer",
        F.col("answer").alias("correct_answer"), "is_correct",
    )


def accuracy_document(acc: DataFrame, subjects: Sequence[str]) -> DataFrame:
    """The accuracies as one JSON text (``document``): two entries per listed subject."""
    listed = F.array(*[F.lit(s) for s in subjects])
    own = acc.select(
        F.when(F.col("is_total"), len(subjects) + 1)
        .otherwise(F.array_position(listed, F.col("subject"))).alias("no"),
        F.when(F.col("is_total"), TASK).otherwise(F.concat(F.lit(f"{TASK}_"), "subject")).alias("key"),
        "acc", F.col("samples"), F.lit(None).cast("double").alias("acc_stderr"),
    )
    compatible = listed_accuracy(acc, subjects).select(
        (F.col("subject_no") + len(subjects) + 1).alias("no"), "key", "acc",
        F.lit(None).cast("bigint").alias("samples"), "acc_stderr",
    )
    entries = own.unionByName(compatible).agg(
        F.array_sort(
            F.collect_list(F.struct("no", "key", F.struct("acc", "samples", "acc_stderr").alias("value")))
        ).alias("entries")
    )
    results = F.map_from_entries(F.transform("entries", lambda e: F.struct(e["key"], e["value"])))
    return entries.select(
        F.to_json(
            F.struct(
                results.alias("results"),
                F.struct(F.lit("1.0").alias(f"{TASK}_native")).alias("versions"),
                F.struct(F.lit(None).cast("string").alias("none")).alias("config"),
            )
        ).alias("document")
    )

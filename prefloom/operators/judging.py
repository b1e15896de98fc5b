"""Judge input checks, scores, statistics and distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import judge_prompt
from prefloom.functions.text import judge_score, py_round, score_tag
from prefloom.operators.staging import compute_once

# Labels of the score distribution and the range each counts.
BANDS = [
    ("9-10分", 9.0, 10.0, True),
    ("8-8.9分", 8.0, 9.0, False),
    ("7-7.9分", 7.0, 8.0, False),
    ("6-6.9分", 6.0, 7.0, False),
    ("5分以下", None, 5.0, False),
]
GAP_BAND = ("5-5.9分", 5.0, 6.0, False)


def judge_input_reason(records: DataFrame) -> DataFrame:
    """Add ``reason``, NULL for records that can be judged.

    ``records`` has VARIANT columns ``instruction`` and ``response``: an absent
    field is NULL there, a JSON null is not, and a null response is judged.
    """
    instruction = F.try_variant_get("instruction", "$", "string")
    return records.withColumn(
        "reason",
        F.when(F.col("response").isNull(), "missing_response").when(
            instruction.isNull(), "missing_instruction"
        ),
    )


def with_judge_prompt(df: DataFrame, name: str = "prompt") -> DataFrame:
    return df.withColumn(
        name, judge_prompt(F.col("instruction"), F.col("ground_truth"), F.col("response"))
    )


def score_replies(df: DataFrame, reply: str = "judge_response") -> DataFrame:
    """Score and status of each judge reply.

    A failed call (NULL reply) scores 0 and is an error; a ``status`` column
    left by the call names the error, and the reply then shows it.
    """
    text = F.col(reply)
    error = F.lit("no reply")
    if "status" in df.columns:
        after = F.substr(F.col("status"), F.lit(len("error: ") + 1))
        error = F.when(F.col("status").startswith("error: "), after).otherwise(error)
    kept = [c for c in df.columns if c not in (reply, "status", "score")]
    tagged = df.withColumn("_tag", score_tag(text))
    return compute_once(tagged, "_raw", judge_score(text, F.col("_tag"))).select(
        *kept,
        F.when(text.isNull(), F.concat(F.lit("[ERROR: "), error, F.lit("]"))).otherwise(text).alias(reply),
        F.coalesce(py_round(F.col("_raw"), 2), F.lit(0.0)).alias("score"),
        F.when(text.isNull(), F.concat(F.lit("error: "), error)).otherwise("success").alias("status"),
    )


def _ok():
    return F.col("status") == "success"


def judge_summary(scored: DataFrame) -> DataFrame:
    ok_score = F.when(_ok(), F.col("score"))
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_ok()).alias("successful"),
        F.count_if(~_ok()).alias("failed"),
        F.coalesce(py_round(F.avg(ok_score), 2), F.lit(0.0)).alias("average_score"),
    )


def judge_stats(scored: DataFrame) -> DataFrame:
    """Score statistics in one pass; no row when nothing was scored.

    The median is the upper one. Its exact buffer holds one entry per distinct
    score, and scores have two decimals within 0..10, so at most 1,001.
    """
    ok_score = F.when(_ok(), F.col("score"))
    raw = scored.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(_ok()).alias("ok"),
        F.avg(ok_score).alias("mean"),
        F.max(ok_score).alias("max_score"),
        F.min(ok_score).alias("min_score"),
        F.expr(
            "percentile_disc(0.5) WITHIN GROUP (ORDER BY score DESC) FILTER (WHERE status = 'success')"
        ).alias("median_score"),
        F.var_pop(ok_score).alias("variance"),
        F.stddev_pop(ok_score).alias("std_dev"),
    ).filter(F.col("ok") > 0)
    return raw.select(
        "total_items",
        F.col("ok").alias("successful_evaluations"),
        (F.col("total_items") - F.col("ok")).alias("failed_evaluations"),
        py_round(F.col("ok") / F.col("total_items") * 100, 2).alias("success_rate"),
        py_round(F.col("mean"), 2).alias("average_score"),
        "max_score", "min_score", "median_score",
        py_round(F.col("variance"), 4).alias("score_variance"),
        py_round(F.col("std_dev"), 4).alias("score_std_dev"),
    )


def judge_distribution(scored: DataFrame, with_gap_bucket: bool = False) -> DataFrame:
    """Count and share of the successful scores per band, zeros included.

    Scores in [5, 6) are in no band unless ``with_gap_bucket`` adds one.
    """
    score = F.when(_ok(), F.col("score"))
    bands = [*BANDS[:4], GAP_BAND, *BANDS[4:]] if with_gap_bucket else BANDS
    counts = []
    for label, low, high, closed in bands:
        inside = score <= high if closed else score < high
        if low is not None:
            inside = inside & (score >= low)
        counts.append(F.count_if(inside).alias(label))
    one_row = scored.agg(F.count(score).alias("ok"), *counts)
    entries = F.array(*[
        F.struct(F.lit(i).alias("band"), F.lit(b[0]).alias("label"), F.col(f"`{b[0]}`").alias("n"))
        for i, b in enumerate(bands)
    ])
    share = F.when(F.col("ok") > 0, py_round(F.col("n") / F.col("ok") * 100, 2)).otherwise(0.0)
    return one_row.select("ok", F.inline(entries)).select(
        "band", "label", "n", share.alias("percentage")
    )


def statistics_document(scored: DataFrame) -> DataFrame:
    """The statistics as one JSON text (``document``): a few dozen numbers.

    The single scores stay in the table and are not gathered into the document.
    """
    bands = judge_distribution(scored).agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("band", "label", "n"))),
                lambda b: F.struct(b["label"], b["n"]),
            )
        ).alias("distribution")
    )
    # one row on either side
    both = judge_stats(scored).withColumn("_one", F.lit(1)).join(bands.withColumn("_one", F.lit(1)), "_one")
    return both.select(
        F.to_json(
            F.struct(
                F.struct(
                    "total_items", "successful_evaluations", "failed_evaluations", "success_rate"
                ).alias("summary"),
                F.struct("average_score", "max_score", "min_score", "median_score").alias("scores"),
                "distribution",
                F.struct("score_variance", "score_std_dev").alias("details"),
            )
        ).alias("document")
    )

"""From response records to judge statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from prefloom.functions.prompts import CHATML, ChatTemplate, compose_prompt, message, render_chat
from prefloom.operators.chat import response_rows
from prefloom.operators.completion import (
    Generated, Responder, complete, complete_stored, split_generated, spread,
)
from prefloom.operators.judging import (
    judge_distribution, judge_input_reason, judge_stats, judge_summary, score_replies, statistics_document,
    with_judge_prompt,
)
from prefloom.sources.records import is_complete, typed
from pyspark.sql import functions as F


def generate_responses(
    rows: DataFrame,
    out: str,
    responder_factory: Callable[[], Responder],
    template: ChatTemplate = CHATML,
    partitions: int | None = None,
    **options,
) -> Generated:
    """One stripped response per instruction row; rows without an instruction or a
    reply are rejects. All replies are written to ``out`` once."""
    chat = render_chat(
        F.array(message("user", compose_prompt(F.col("instruction"), F.col("input")))), template
    )
    answered = complete_stored(spread(rows, partitions), chat, "instruction", out, responder_factory, **options)
    return split_generated(answered, lambda good: response_rows(good, keep=("pos",)))


@dataclass(frozen=True)
class Judged:
    """The stored scores and what is computed from them."""

    scores: DataFrame
    rejects: DataFrame
    summary: DataFrame
    statistics: DataFrame
    distribution: DataFrame
    document: DataFrame


def judge_records(
    records: DataFrame,
    out: str,
    responder_factory: Callable[[], Responder],
    partitions: int | None = None,
    **options,
) -> Judged:
    """Judge response records (VARIANT fields ``instruction``, ``ground_truth`` and
    ``response``, with ``pos``).

    The scores are written to ``out`` once; a finished ``out`` is used as it is,
    so no reply is asked for twice.
    """
    spark: SparkSession = records.sparkSession
    checked = judge_input_reason(records)
    if not is_complete(spark, out):
        accepted = typed(
            checked.filter(F.col("reason").isNull()),
            {"instruction": "string", "ground_truth": "string", "response": "string"},
        ).drop("reason")
        replied = complete(
            with_judge_prompt(spread(accepted, partitions)), "prompt", responder_factory,
            out="judge_response", keep_prompt=False, **options,
        )
        score_replies(replied).write.mode("overwrite").parquet(out)
    scores = spark.read.parquet(out)
    rejects = checked.filter(F.col("reason").isNotNull()).select("pos", "reason")
    return Judged(
        scores, rejects, judge_summary(scores), judge_stats(scores), judge_distribution(scores), statistics_document(scores)
    )

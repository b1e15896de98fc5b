"""From choice questions to accuracies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import CHATML, ChatTemplate, message, render_chat
from prefloom.operators.choice import (
    accuracy, accuracy_document, answer_details, grade_answers, limit_per_subject, listed_accuracy,
    number_per_subject, running_accuracy, select_subjects, with_choice_prompt,
)
from prefloom.operators.completion import Responder, complete, spread
from prefloom.sources.records import write_once


@dataclass(frozen=True)
class ChoiceResult:
    """The stored details and the figures computed from the answered questions;
    ``failed`` has those whose call failed, with their status."""

    details: DataFrame
    failed: DataFrame
    accuracy: DataFrame
    listed: DataFrame
    running: DataFrame
    document: DataFrame


def evaluate_choices(
    questions: DataFrame,
    subjects: Sequence[str],
    out: str,
    responder_factory: Callable[[], Responder],
    limit: int | None = None,
    every: int = 100,
    template: ChatTemplate = CHATML,
    partitions: int | None = None,
    **options,
) -> ChoiceResult:
    """Ask the listed subjects' questions and grade the replies.

    The graded answers are written to ``out`` once, with the status of their call.
    A failed call is no wrong answer: it is listed apart.
    """
    chosen = select_subjects(questions, subjects)
    numbered = number_per_subject(chosen) if limit is None else limit_per_subject(chosen, limit)
    prompted = with_choice_prompt(spread(numbered, partitions))
    chat = render_chat(F.array(message("user", F.col("prompt"))), template)
    answered = complete(
        prompted.withColumn("_chat", chat), "_chat", responder_factory,
        out="model_output", keep_prompt=False, **options,
    )
    write_once(grade_answers(answered), out)
    stored = questions.sparkSession.read.parquet(out)
    graded = stored.filter("status = 'success'")
    failed = stored.filter("status <> 'success'").select("pos", "subject", "question_id", "status")
    acc = accuracy(graded)
    return ChoiceResult(
        answer_details(graded), failed, acc, listed_accuracy(acc, subjects), running_accuracy(graded, every),
        accuracy_document(acc, subjects),
    )

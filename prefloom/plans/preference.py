"""From instruction rows to ranked candidates and training pairs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from prefloom.functions.prompts import CHATML, ChatTemplate, compose_prompt, message, render_chat
from prefloom.operators.chat import candidate_rows
from prefloom.operators.completion import Generated, Responder, complete_stored, split_generated, spread
from prefloom.operators.preference import (
    candidate_reason, clean_preferences, observe_cleaning, preference_pairs,
)
from prefloom.operators.splits import first_n
from prefloom.operators.staging import written
from prefloom.sources.records import typed
from prefloom.streaming.ranking import rank_run, read_results


def generate_candidates(
    rows: DataFrame,
    out: str,
    responder_factory: Callable[[], Responder],
    samples: int = 4,
    template: ChatTemplate = CHATML,
    partitions: int | None = None,
    **options,
) -> Generated:
    """``samples`` stripped responses per instruction row that got all of them; other
    rows are rejects. All replies are written to ``out`` once."""
    chat = render_chat(
        F.array(message("user", compose_prompt(F.col("instruction"), F.col("input")))), template
    )
    answered = complete_stored(
        spread(rows, partitions), chat, "instruction", out, responder_factory,
        out="responses", k=samples, **options,
    )
    if samples == 1:
        answered = answered.withColumn("responses", F.array("responses"))
    return split_generated(answered, lambda good: candidate_rows(good, keep=("pos",)))


def accept_candidates(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """VARIANT records split into typed candidates and rejects (pos, reason)."""
    checked = candidate_reason(records)
    accepted = typed(
        checked.filter(F.col("reason").isNull()),
        {"instruction": "string", "input": "string", "ground_truth": "string", "responses": "array<string>"},
    ).drop("reason")
    return accepted, checked.filter(F.col("reason").isNotNull()).select("pos", "reason")


def rank_candidates(
    candidates: DataFrame,
    results: str,
    batch: int,
    responder_factory: Callable[[], Responder],
    **options,
) -> DataFrame:
    """Rank what is still open and return the results as of this run."""
    rank_run(candidates, results, batch, responder_factory, **options)
    return read_results(candidates.sparkSession, results, batch)


@dataclass(frozen=True)
class Pairs:
    """Training pairs; ``counts`` fills with raw and clean rows when they are used."""

    rows: DataFrame
    counts: Observation


def training_pairs(
    ranked: DataFrame,
    max_samples: int | None = None,
    template: ChatTemplate = CHATML,
    include_input: bool = False,
    strip_first: bool = False,
    keep: tuple[str, ...] = (),
) -> Pairs:
    """Clean ranked rows, cap them in list order and form the pairs."""
    counts = Observation("cleaning")
    cleaned = clean_preferences(observe_cleaning(ranked, counts, strip_first), strip_first)
    return Pairs(
        preference_pairs(first_n(cleaned, max_samples), template, include_input, keep), counts
    )


@dataclass(frozen=True)
class StoredPairs:
    """Written training pairs and the rows left after each stage, as (step, stage, n)."""

    rows: DataFrame
    counts: DataFrame


def store_pairs(
    ranked: DataFrame,
    out: str,
    max_samples: int | None = None,
    template: ChatTemplate = CHATML,
    include_input: bool = False,
    strip_first: bool = False,
    keep: tuple[str, ...] = (),
) -> StoredPairs:
    """``training_pairs`` written to ``out``, with all four counts observed while that is done.

    ``ranked`` is read, parsed and cleaned once; the cap looks at what was kept of it.
    """
    spark = ranked.sparkSession
    seen, kept, paired = (Observation(n) for n in ("seen", "capped", "pairs"))
    cleaned = written(clean_preferences(observe_cleaning(ranked, seen, strip_first), strip_first), "cleaned")
    everything = F.count(F.lit(1)).alias("n")
    capped = first_n(cleaned, max_samples).observe(kept, everything)
    preference_pairs(capped, template, include_input, keep).observe(paired, everything).write.parquet(out)
    counts = [
        (1, "raw", seen.get["raw"]), (2, "cleaned", seen.get["cleaned"]), (3, "capped", kept.get["n"]), (4, "pairs", paired.get["n"]),
    ]
    return StoredPairs(spark.read.parquet(out), spark.createDataFrame(counts, "step int, stage string, n bigint"))

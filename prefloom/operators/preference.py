"""Ranked candidates: checks, ranking replies, cleaning, pairs and resume by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import (
    CHATML, ChatTemplate, compose_prompt, message, rank_prompt, render_chat,
)
from prefloom.functions.text import py_strip, ranking_numbers, valid_ranking
from prefloom.operators.skew import anti_join
from prefloom.operators.staging import compute_once

# Fixed value: what a row without a usable ranking keeps as its reply.
UNKNOWN_ERROR = "Unknown error"


def candidate_reason(records: DataFrame) -> DataFrame:
    """Add ``reason``, NULL for records that can be ranked.

    ``records`` has VARIANT columns ``instruction`` and ``responses``; the
    latter has to be a list of at least two.
    """
    responses = F.try_variant_get("responses", "$", "array<variant>")
    missing = F.col("instruction").isNull() | F.col("responses").isNull()
    return records.withColumn(
        "reason",
        F.when(missing, "missing_field")
        .when(responses.isNull() | (F.size(responses) < 2), "invalid_responses")
        .when(F.try_variant_get("instruction", "$", "string").isNull(), "null_instruction"),
    )


def with_rank_prompt(df: DataFrame, name: str = "prompt", prompt_fix: bool = False) -> DataFrame:
    return df.withColumn(
        name, rank_prompt(F.col("instruction"), F.col("responses"), prompt_fix)
    )


def parse_rankings(
    df: DataFrame, reply: str = "api_response", strict_permutation: bool = False
) -> DataFrame:
    """``sorted_indices`` (NULL when unusable), ``rank_status`` and the raw reply.

    ``api_response`` keeps the reply of a usable ranking only, as the stored
    results do; ``raw_reply`` has it in every case.
    """
    n = F.size("responses")
    kept = [c for c in df.columns if c not in (reply, "api_response", "sorted_indices")]
    raw = df.select(*kept, F.col(reply).alias("raw_reply"))
    parsed = compute_once(raw, "_numbers", ranking_numbers(F.col("raw_reply"))).withColumn(
        "sorted_indices", valid_ranking(F.col("_numbers"), n, strict_permutation)
    )
    usable = F.col("sorted_indices").isNotNull()
    return parsed.select(
        *kept, "sorted_indices",
        F.when(usable, F.col("raw_reply")).otherwise(UNKNOWN_ERROR).alias("api_response"),
        "raw_reply",
        F.when(usable, "ok")
        .when(F.col("raw_reply").isNull(), "no_reply")
        .when(F.col("_numbers").isNull(), "no_prefix")
        .otherwise("bad_ranking").alias("rank_status"),
    )


def clean_reason(strip_first: bool = False) -> Column:
    """Why a ranked row is dropped (the first reason that applies), NULL if it stays."""
    responses = F.col("responses")
    if strip_first:
        responses = F.transform(responses, py_strip)
    return (
        F.when(F.col("sorted_indices").isNull(), "no_ranking")
        .when(F.col("responses").isNull(), "no_responses")
        .when(F.size(F.array_distinct(responses)) < F.size("responses"), "duplicate_responses")
        .when(F.size("responses") < 2, "too_few_responses")
    )


def clean_preferences(ranked: DataFrame, strip_first: bool = False) -> DataFrame:
    """Rows without a ``clean_reason``, as conditions that can reach a scan."""
    responses = F.col("responses")
    if strip_first:
        responses = F.transform(responses, py_strip)
    return ranked.filter(
        F.col("sorted_indices").isNotNull()
        & (F.size("responses") >= 2)
        & (F.size(F.array_distinct(responses)) == F.size("responses"))
    )


def reject_reasons(ranked: DataFrame, strip_first: bool = False) -> DataFrame:
    return (
        ranked.select(clean_reason(strip_first).alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    )


def _pair_text(place: Column) -> Column:
    """Response at an index; NULL when the index is out of range."""
    return F.get("responses", place)


def preference_pairs(
    cleaned: DataFrame,
    template: ChatTemplate = CHATML,
    include_input: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(prompt, chosen, rejected) from the first and last ranked response.

    The prompt is made of the stripped instruction alone unless
    ``include_input`` is set, although generation saw the input too.
    """
    indices = F.col("sorted_indices")
    best = _pair_text(F.get(indices, F.lit(0)))
    worst = _pair_text(F.get(indices, F.size(indices) - 1))
    content = py_strip(F.coalesce("instruction", F.lit("")))
    if include_input:
        content = compose_prompt(content, F.col("input"))
    return cleaned.filter((F.size(indices) >= 2) & best.isNotNull() & worst.isNotNull()).select(
        *keep,
        render_chat(F.array(message("user", content)), template).alias("prompt"),
        py_strip(best).alias("chosen"),
        py_strip(worst).alias("rejected"),
    )


def instruction_key(key_cols: Sequence[str] = ("instruction",)) -> Column:
    """Hash that identifies a row across runs; by default of the instruction alone."""
    if len(key_cols) == 1:
        return F.md5(F.col(key_cols[0]))
    return F.md5(F.to_json(F.struct(*key_cols)))


def _has_ranking() -> Column:
    return F.col("sorted_indices").isNotNull()


def _key(df: DataFrame, key_cols: Sequence[str]) -> Column:
    """The stored key where there is one: results then need not read their texts."""
    return F.col("key") if "key" in df.columns else instruction_key(key_cols)


def pending_rows(
    rows: DataFrame,
    results: DataFrame,
    key_cols: Sequence[str] = ("instruction",),
    row_id: str = "pos",
    few_rows: bool = False,
) -> DataFrame:
    """Rows whose key has no ranking in ``results`` yet, with their ``key``.

    With ``few_rows`` the results are first cut down to the keys of ``rows``:
    a short list of keys is broadcast by Spark's size check, and the long
    history is then scanned but not shuffled.
    """
    done = results.filter(_has_ranking()).select(_key(results, key_cols).alias("key"))
    asked = rows.filter(F.col("instruction").isNotNull()).withColumn("key", instruction_key(key_cols))
    if few_rows:
        done = done.join(asked.select("key"), "key", "left_semi")
    return anti_join(asked, done, "key", row_id)


def last_orders(
    rows: DataFrame,
    key_cols: Sequence[str] = ("instruction",),
    order_cols: Sequence[str] = ("batch", "pos"),
    prefer_success: bool = False,
) -> DataFrame:
    """``order_cols`` of the row that ``last_per_key`` keeps for every key, without its texts."""
    order = list(order_cols)
    rank = F.struct(*([F.col("sorted_indices").isNotNull().alias("_ok")] if prefer_success else []), *order)
    return (
        rows.groupBy(_key(rows, key_cols).alias("key")).agg(F.max(rank).alias("_last"))
        .select(*[F.col(f"_last.{c}").alias(c) for c in order])
    )


def last_per_key(
    rows: DataFrame,
    key_cols: Sequence[str] = ("instruction",),
    order_cols: Sequence[str] = ("batch", "pos"),
    prefer_success: bool = False,
) -> DataFrame:
    """For every key the row that is last in ``order_cols``, which are unique.

    Winners are found on (key, order) alone, where partial aggregation collapses
    copies before the shuffle; the wide rows are then matched on the unique
    order columns, so a key with many copies never meets in one task.
    """
    winners = last_orders(rows, key_cols, order_cols, prefer_success)
    return rows.join(winners, list(order_cols), "left_semi").withColumn("key", _key(rows, key_cols))


def upsert_results(
    earlier: DataFrame, new: DataFrame, key_cols: Sequence[str] = ("instruction",), prefer_success: bool = False
) -> DataFrame:
    """Earlier rankings updated by a new run: the last position of the new run
    wins, with or without a ranking, unless ``prefer_success`` is set."""
    both = (
        earlier.filter(_has_ranking() & F.col("instruction").isNotNull()).withColumn("batch", F.lit(0))
        .unionByName(new.filter(F.col("instruction").isNotNull()).withColumn("batch", F.lit(1)))
    )
    return last_per_key(both, key_cols, prefer_success=prefer_success)


def current_results(
    runs: DataFrame, last_batch: int | None = None, key_cols: Sequence[str] = ("instruction",)
) -> DataFrame:
    """State after run ``last_batch``, or after all runs: earlier failures are gone,
    the run's own remain. Without a batch every key that never got a ranking keeps
    its last failure."""
    if last_batch is None:
        return last_per_key(runs, key_cols, prefer_success=True)
    live = runs.filter(
        (F.col("batch") <= last_batch) & (_has_ranking() | (F.col("batch") == last_batch))
    )
    return last_per_key(live, key_cols)


def stage_counts(
    ranked: DataFrame, capped: DataFrame, pairs: DataFrame, strip_first: bool = False
) -> DataFrame:
    """Rows left after each stage as (step, stage, n)."""
    def entries(df, *stages):
        rows = [
            F.struct(F.lit(step).alias("step"), F.lit(name).alias("stage"), count.alias("n"))
            for step, name, count in stages
        ]
        return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))

    everything = F.count(F.lit(1))
    return (
        entries(
            ranked, (1, "raw", everything), (2, "cleaned", F.count_if(clean_reason(strip_first).isNull()))
        )
        .unionByName(entries(capped, (3, "capped", everything)))
        .unionByName(entries(pairs, (4, "pairs", everything)))
    )


def observe_cleaning(ranked: DataFrame, observation, strip_first: bool = False) -> DataFrame:
    """Count raw and clean rows while the caller's own job runs, with no extra pass."""
    return ranked.observe(
        observation,
        F.count(F.lit(1)).alias("raw"),
        F.count_if(clean_reason(strip_first).isNull()).alias("cleaned"),
    )

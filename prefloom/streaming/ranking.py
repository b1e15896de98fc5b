"""Resumable ranking runs, in batch and as a stream over new candidate files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prefloom.operators.completion import Responder, complete, spread
from prefloom.operators.preference import (
    current_results, parse_rankings, pending_rows, with_rank_prompt,
)
from prefloom.sources import shared
from prefloom.sources.records import read_if_present

# VARIANT-free candidate row; more columns may follow
RESULT_FIELDS = (
    "pos bigint, instruction string, input string, ground_truth string, responses array<string>,"
    " status string, sorted_indices array<bigint>, api_response string, raw_reply string,"
    " rank_status string, key string"
)


def _schema() -> T.StructType:
    return T.StructType.fromDDL(RESULT_FIELDS)


def read_runs(spark: SparkSession, results: str) -> DataFrame:
    """Rows of all runs, with the run number as ``batch``."""
    return read_if_present(spark, results, _schema().add("batch", T.LongType()))


def rank_run(
    candidates: DataFrame,
    results: str,
    batch: int,
    responder_factory: Callable[[], Responder],
    *,
    key_cols: Sequence[str] = ("instruction",),
    strict_permutation: bool = False,
    prompt_fix: bool = False,
    partitions: int | None = None,
    few_rows: bool = False,
    **options,
) -> None:
    """Rank the candidates that have no ranking yet and store them as run ``batch``.

    A run owns one folder and replaces it, so repeating a run that was cut off
    leaves no doubles. Rows that fail are asked again by the next run. A result folder
    is bound to the ``key_cols`` of its first run; other ones are refused. ``few_rows`` is for small
    additions to a long history.
    """
    spark = candidates.sparkSession
    shared.bind(results, key_cols=list(key_cols))
    earlier = read_runs(spark, results)
    done = earlier.filter(earlier["batch"] < batch)
    pending = spread(pending_rows(candidates, done, key_cols, few_rows=few_rows), partitions)
    replied = complete(
        with_rank_prompt(pending, prompt_fix=prompt_fix), "prompt", responder_factory,
        out="api_response", keep_prompt=False, **options,
    )
    ranked = parse_rankings(replied, strict_permutation=strict_permutation)
    ranked.select(*_schema().fieldNames()).write.mode("overwrite").parquet(f"{results}/batch={batch}")


def read_results(
    spark: SparkSession,
    results: str,
    last_batch: int | None = None,
    key_cols: Sequence[str] = ("instruction",),
) -> DataFrame:
    """One row per key as of run ``last_batch``; of all runs without one."""
    shared.bind(results, create=False, key_cols=list(key_cols))
    return current_results(read_runs(spark, results), last_batch, key_cols)


def rank_stream(
    spark: SparkSession,
    candidates: str,
    schema: T.StructType,
    results: str,
    checkpoint: str,
    responder_factory: Callable[[], Responder],
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Rank the candidate files that arrived since the last start, then stop.

    Each micro-batch is one run of at most ``max_files`` files, so one start may
    make many runs; ``read_results`` without a batch has all of them. After a
    failure the stream repeats the batch under the same number, which replaces its
    folder.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(candidates)

    def run(batch: DataFrame, batch_id: int) -> None:
        rank_run(batch, results, batch_id, responder_factory, few_rows=True, **options)

    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

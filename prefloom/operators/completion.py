"""Batch completion: prompts to texts through a user-supplied responder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.operators.positions import number_rows
from prefloom.sources.records import is_complete, write_once

# responder(prompts, seeds) gives one text per prompt
Responder = Callable[[Sequence[str], Sequence[int]], Sequence[str]]


def spread(df: DataFrame, partitions: int | None, row_id: str = "pos") -> DataFrame:
    """Rows over ``partitions`` tasks, so that few input files do not become few
    tasks. Call it before prompts are built: they need not be shuffled."""
    return df.repartition(partitions, row_id) if partitions else df


@dataclass(frozen=True)
class Generated:
    """Rows that got a reply, and (pos, reason) of those that did not."""

    rows: DataFrame
    rejects: DataFrame


def complete_stored(
    rows: DataFrame, prompt: Column, required: str, path: str, responder_factory: Callable[[], Responder], **options
) -> DataFrame:
    """Replies with their ``status``, written to ``path`` once and read back.

    A row whose ``required`` column is NULL is not asked; its status says so. A
    finished ``path`` is used as it is, so no reply is asked for twice.
    """
    spark = rows.sparkSession
    if not is_complete(spark, path):
        asked = rows.filter(F.col(required).isNotNull()).withColumn("_prompt", prompt)
        answered = complete(asked, "_prompt", responder_factory, keep_prompt=False, **options)
        unasked = rows.filter(F.col(required).isNull()).withColumn("status", F.lit(f"null_{required}"))
        write_once(answered.unionByName(unasked, allowMissingColumns=True), path)
    return spark.read.parquet(path)


def split_generated(answered: DataFrame, rows: Callable[[DataFrame], DataFrame]) -> Generated:
    good = F.col("status") == "success"
    failed = answered.filter(~good).select("pos", F.col("status").alias("reason"))
    return Generated(rows(answered.filter(good)), failed)


def ask(responder: Responder, prompts: Sequence[str], seeds: Sequence[int]) -> list[tuple[str | None, str]]:
    """Text and status of every prompt; where the call fails, they are asked one by one."""
    try:
        texts = list(responder(prompts, seeds))
        if len(texts) != len(prompts):
            raise ValueError(f"{len(texts)} texts for {len(prompts)} prompts")
        return [(t, "success" if t is not None else "error: no reply") for t in texts]
    except Exception as e:
        if len(prompts) == 1:
            return [(None, f"error: {e}")]
        return [ask(responder, [p], [s])[0] for p, s in zip(prompts, seeds)]


def complete(
    df: DataFrame,
    prompt_col: str,
    responder_factory: Callable[[], Responder],
    *,
    out: str = "response",
    k: int = 1,
    batch_size: int = 64,
    row_id: str = "pos",
    seed: int = 42,
    keep_prompt: bool = True,
) -> DataFrame:
    """Add ``out`` and ``status`` to every row.

    ``responder_factory`` runs once per task. With ``k`` above 1 ``out`` is an
    array of k samples, taken in the row's own batch, so no row is multiplied or
    regrouped. A prompt whose call fails gets NULL and ``error: <message>``; the
    others of its batch are asked again one by one and keep their texts.

    Seeds come from ``row_id`` and the sample number, so a retried task asks the
    same questions. Without ``keep_prompt`` the prompt does not come back.
    Write the result before using it twice: each action would ask the model anew.
    """
    text = T.ArrayType(T.StringType()) if k > 1 else T.StringType()
    gone = ["_seed"] if keep_prompt else ["_seed", prompt_col]
    schema = T.StructType(
        [
            *[f for f in df.schema.fields if f.name not in gone],
            T.StructField(out, text), T.StructField("status", T.StringType()),
        ]
    )
    arrow_text = pa.list_(pa.string()) if k > 1 else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        responder = responder_factory()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_size):
                batch = whole.slice(start, batch_size)
                prompts = batch.column(prompt_col).to_pylist()
                seeds = batch.column("_seed").to_pylist()
                samples = [
                    ask(responder, prompts, [(s + i) & 0x7FFFFFFF for s in seeds]) for i in range(k)
                ]
                rows = list(zip(*samples))
                texts = [[t for t, _ in r] if k > 1 else r[0][0] for r in rows]
                status = [next((s for _, s in r if s != "success"), "success") for r in rows]
                kept = batch.drop_columns(gone)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(texts, arrow_text), pa.array(status, pa.string())],
                    names=[*kept.schema.names, out, "status"],
                )

    return df.withColumn("_seed", F.xxhash64(F.col(row_id), F.lit(seed))).mapInArrow(run, schema)


def balanced(df: DataFrame, cost: Column, partitions: int, row_id: str = "pos") -> DataFrame:
    """``df`` dealt to ``partitions`` tasks of equal cost, rows of like cost side by side.

    The rows, in the order of ``row_id`` (a unique integer), are cut where the running total of
    their cost passes equal shares, so a task is off by one row's cost at most. Costs are
    summed apart from the rows, which are shuffled twice.
    """
    narrow = df.select(row_id, cost.cast("bigint").alias("_cost"))
    # one number
    total = narrow.agg(F.coalesce(F.sum("_cost"), F.lit(0))).first()[0] or 1
    summed = number_rows(narrow, row_id, number="_n", running={"_upto": F.col("_cost")})
    middle = 2 * F.col("_upto").cast("decimal(38,0)") - F.col("_cost")
    task = F.least(F.floor(middle * partitions / (2 * total)).cast("int"), F.lit(partitions - 1))
    dealt = df.join(summed.select(row_id, "_cost", task.alias("_task")), row_id)
    return dealt.repartitionById(partitions, "_task").sortWithinPartitions("_cost").select(*df.columns)


def complete_balanced(
    df: DataFrame, prompt_col: str, responder_factory: Callable[[], Responder], partitions: int, *, row_id: str = "pos", **options
) -> DataFrame:
    """``complete`` over tasks with equal totals of prompt characters; a batch holds prompts of like length."""
    dealt = balanced(df, F.coalesce(F.length(prompt_col), F.lit(0)) + 1, partitions, row_id)
    return complete(dealt, prompt_col, responder_factory, row_id=row_id, **options)

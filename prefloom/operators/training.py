"""Token tables, padded batches and the step plan."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.operators.positions import number_rows

LABEL_PAD = -100  # fixed value: the label a loss function ignores


# tokenizer(texts) gives one list of ids per text
Tokenizer = Callable[[list[str]], Sequence[Sequence[int]]]


def token_rows(
    df: DataFrame,
    text: str,
    tokenizer_factory: Callable[[], Tokenizer],
    max_tokens: int | None = None,
    keep: tuple[str, ...] = ("pos",),
) -> DataFrame:
    """``input_ids`` and equal ``labels``; the tokenizer is made once per task and
    takes a batch of texts at a time."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_factory()
        for batch in batches:
            ids = pa.array(tokenizer(batch.column("_text").to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*keep, "input_ids"])

    # filtered first, so the tokenizer never sees a NULL
    rows = df.filter(F.col(text).isNotNull()).select(*keep, F.col(text).alias("_text"))
    schema = rows.drop("_text").schema.add("input_ids", T.ArrayType(T.IntegerType()))
    tokens = rows.mapInArrow(encode, schema)
    if max_tokens is not None:
        tokens = tokens.withColumn("input_ids", F.slice("input_ids", 1, max_tokens))
    return tokens.withColumn("labels", F.col("input_ids"))


def _pad(ids: Column, width: Column, value: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(value), width - F.size(ids)))


def padded_batches(tokens: DataFrame, size: int, pad_id: int, key: str = "pos") -> DataFrame:
    """Rows in list order cut into batches of ``size``, padded to the longest of each.

    Places and widths come from the lengths alone, so the ids are shuffled once; the
    labels are made of them at the end. ``tokens`` is used twice: store it first.
    """
    lengths = tokens.select(key, F.size("input_ids").alias("_length"))
    numbered = number_rows(lengths, key, number="_row").withColumn("batch", F.floor(F.col("_row") / size))
    # at most ``size`` rows per window partition
    width = F.max("_length").over(Window.partitionBy("batch"))
    places = numbered.select(key, "batch", width.alias("width"))
    return tokens.select(key, "input_ids").join(places, key).select(
        key, "batch", "width",
        _pad(F.col("input_ids"), F.col("width"), pad_id).alias("input_ids"),
        _pad(F.col("input_ids"), F.col("width"), LABEL_PAD).alias("labels"),
    )


def step_plan(df: DataFrame, batch_size: int, accumulation: int, epochs: int = 1) -> DataFrame:
    """Optimiser steps for the rows: the last, incomplete step counts."""
    rows = F.col("row_count")
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(batch_size).alias("batch_size"),
        F.lit(accumulation).alias("accumulation"),
        (F.ceil(F.ceil(rows / batch_size) / accumulation) * epochs).alias("steps"),
    )


ROUNDS = 6  # Feistel rounds
WALKS = 64  # applications after which a place has to be in range


def _round_number(value: Column, seed: int, epoch: Column, turn: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.lit(str(turn)), value.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def permuted(place: Column, rows: int, epoch: Column, seed: int) -> Column:
    """The place of row ``place`` (0 to ``rows`` - 1) in the order of ``epoch``: a permutation, computed
    for each row alone.

    A place is a pair of digits to the bases a and b, the least about the root of ``rows``. Each round
    adds a number made from one digit to the other, which can be undone, so all rounds
    permute the a * b pairs. A result beyond the rows goes in again until it is one of them;
    fewer than a places are beyond, so that hardly ever happens more than once.
    """
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    b = max(1, -(-rows // a))

    def once(x: Column) -> Column:
        pair = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, F.lit(b)).cast("bigint").alias("r"))
        for turn in range(ROUNDS):
            pair = _turned(pair, a, b, seed, epoch, turn)
        return pair["l"] * b + pair["r"]

    first = once(place.cast("bigint"))
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < rows, x).otherwise(once(x))
    )
    inside = F.when(first < rows, first).otherwise(walked)
    return F.when(inside < rows, inside).otherwise(F.raise_error(F.lit("no place in range")).cast("bigint"))


def _turned(pair: Column, a: int, b: int, seed: int, epoch: Column, turn: int) -> Column:
    """One round: the left digit changes in even rounds, the right one in odd ones."""
    def step(p: Column) -> Column:
        if turn % 2 == 0:
            return F.struct(F.pmod(p["l"] + _round_number(p["r"], seed, epoch, turn), F.lit(a)).alias("l"), p["r"].alias("r"))
        return F.struct(p["l"].alias("l"), F.pmod(p["r"] + _round_number(p["l"], seed, epoch, turn), F.lit(b)).alias("r"))

    # computed once, though mentioned twice
    return F.transform(F.array(pair), step)[0]


def epoch_plan(
    examples: DataFrame, epochs: int, batch_size: int, accumulation: int, seed: int = 42, place: str = "pos"
) -> DataFrame:
    """(epoch, step, slot, pos) of every example in every epoch; ``place`` counts them from 0.

    No sort and no shuffle: where a row comes in an epoch follows from its own place.
    """
    rows = examples.count()
    width = batch_size * accumulation
    every = examples.select(place, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    at = every.withColumn("_at", permuted(F.col(place), rows, F.col("epoch"), seed))
    return at.select(
        "epoch", F.floor(F.col("_at") / width).cast("bigint").alias("step"), F.pmod("_at", F.lit(width)).cast("bigint").alias("slot"), place
    )

"""From a stored instruction table to its three written parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefloom.operators.splits import cut_positions
from prefloom.sources.records import file_starts, is_complete, read_range, write_once


def split_snapshot(
    spark: SparkSession,
    path: str,
    out: str,
    train: int = 50_000,
    preference: int = 10_000,
    evaluation: int = 500,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Cut a Parquet table in stored row order; parts that are already written stay.

    Every part is read from the files that hold its rows. The parts keep the
    position ``pos`` of the whole table.
    """
    starts = file_starts(spark, path)
    schema = spark.read.parquet(path).schema
    total = starts.agg(F.sum("rows")).first()[0] or 0
    cuts = cut_positions(total, train, preference, evaluation)
    parts = {"train": cuts.train, "preference": cuts.preference, "evaluation": cuts.evaluation}
    for name, (begin, end) in parts.items():
        if not is_complete(spark, f"{out}/{name}"):
            write_once(read_range(spark, starts, begin, end, schema), f"{out}/{name}", fmt)
    return {name: spark.read.format(fmt).load(f"{out}/{name}") for name in parts}

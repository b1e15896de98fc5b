"""Keeping costly expressions single."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefloom.session import scratch_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name``, computed once per row.

    A filter on a plain computed column is pushed below its projection, where
    each mention computes the expression again; later projections compute it once
    more. A generator of one element gives the same rows, stays in generated
    code, and keeps such filters above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What an action in here shuffles goes as soon as it ends, not when the driver happens
    to collect its garbage. Frames made in here are for one action each."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once however often
    it is used, and unharmed by lost executors."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

"""Joins on keys of which a few may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK_ROWS = 1 << 20  # rows of one key that a task should get at most


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Hashes of the keys with more than ``task_rows`` rows, and the salts each needs.

    Counting collapses copies before the shuffle and moves 16 bytes per distinct
    key. The result has at most rows / task_rows rows, about one per million.
    """
    return (
        df.groupBy(F.xxhash64(key).alias("_hash")).count()
        .filter(F.col("count") > task_rows)
        .select("_hash", F.ceil(F.col("count") / task_rows).cast("int").alias("_salts"))
    )


def anti_join(left: DataFrame, right: DataFrame, key: str, row_id: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``left`` rows whose ``key`` is not in ``right``.

    Rows of a hot key are spread by ``row_id`` over as many salts as its count asks
    for, and the one right row of that key is repeated once per salt; all other
    rows keep salt 0.
    """
    # at most rows / task_rows rows, see hot_keys
    hot = F.broadcast(hot_keys(left, key, task_rows))
    salts = F.coalesce("_salts", F.lit(1))
    spread = left.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left").withColumn(
        "_salt", F.pmod(F.xxhash64(row_id), salts).cast("int")
    )
    keys = (
        right.select(key).distinct()
        .withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
        .select(key, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    )
    return spread.join(keys, [key, "_salt"], "left_anti").select(*left.columns)

"""Intermediate tables in the shared folder, and links joined to components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.session import scratch_folder
from prefloom.sources.records import delete_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage,
    survives lost executors and is computed once however often it is used. What was
    shuffled for it goes as soon as it is written."""
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(folder)
    table.scratch_path = folder
    return table


def drop(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that no result still to be computed reads."""
    for table in tables:
        delete_path(table.sparkSession, table.scratch_path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until it is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def most_frequent(counts: DataFrame, keep: int, *ties: str) -> DataFrame:
    """The ``keep`` rows with the largest ``n``, ties by the columns ``ties``. Counts per
    eighth of an octave tell beforehand which rows can be among them, so that no task
    gets ``keep`` rows from every other."""
    level = F.floor(F.log2(F.col("n")) * 8).cast("int")
    above, least = 0, 0
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        above, least = above + row["count"], row["level"]
        if above >= keep:
            break
    return counts.filter(level >= least).orderBy(F.desc("n"), *ties).limit(keep)


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b: any orderable type, never null).

    Returns (id, component) with the smallest id reachable, for every id that has
    a link to another; ``drop`` frees it. Alternating large and small stars: each round replaces
    links by links to smaller ids, so the number of links never grows, and rounds grow with
    the logarithm of the longest chain. The links of a hub stay where they are: its
    smallest neighbour comes from partial aggregation and is broadcast. Every round is stored.
    """
    links = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    before, n = None, links.count()
    while True:
        # a star reads its links several times: stored between, plans stay as small as one star
        for star in (_large_star, _small_star):
            last, links = links, star(links, n)
            drop(last)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, now[0]
    # stable: every id but the smallest points at the smallest of its component
    found = links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
    found.scratch_path = links.scratch_path
    return found


HUBS = 20_000
LEAST_HUB = 10_000  # links: fewer are no skew


def _with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """``rows`` (a, b) with m of ``least`` (a, m, n). Ids with more than a share of
    1 / HUBS of about ``n`` links, of which there can be some HUBS only, are broadcast."""
    hub = F.col("n") * HUBS > F.greatest(F.lit(2 * n), F.lit(HUBS * LEAST_HUB))
    hubs = least.filter(hub).select("a", "m")
    if hubs.isEmpty():
        return rows.join(least.select("a", "m"), "a")
    at_hubs = rows.join(F.broadcast(hubs), "a")
    others = rows.join(F.broadcast(hubs.select("a")), "a", "left_anti").join(least.filter(~hub).select("a", "m"), "a")
    return at_hubs.union(others)


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    moved = stored(_with_least(both.filter("b > a"), least, n).select(F.col("b").alias("a"), F.col("m").alias("b")), "links")
    drop(least)
    return moved


def _small_star(links: DataFrame, n: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = stored(down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    moved = _with_least(down, least, n).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = stored(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    drop(least)
    return moved


def per_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``work`` on the rows of every group of the integer ``keys``. Groups are told apart in one
    sorted stream per task, which for many small groups is far cheaper than a
    Python call and an Arrow stream each; memory holds one group and one batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            table = pa.Table.from_batches([batch])
            if held and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in zip(keys, columns, strict=True)):
                held.append(table.slice(0, cuts[1]))
                cuts = cuts[1:]
            if len(cuts) == 1:
                continue
            done = [table.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
            groups = ([pa.concat_tables(held)] if held else []) + done[:-1]
            held = done[-1:]
            yield from _worked(groups)
        if held:
            yield from _worked([pa.concat_tables(held)])

    def _worked(groups: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        out = [t for t in map(work, groups) if t is not None and t.num_rows]
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(rows, schema)

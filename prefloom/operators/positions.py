"""List positions without a global sort in one task.

The reference data model is a list, so splits, caps, numbering and running
figures all depend on row positions. Three ways to get them:

* ``with_position``: any unique order columns. One range shuffle, written once
  to a shared folder, then a join with one offset per written partition.
* ``number_rows``: a unique integer key that follows the list order. One hash
  shuffle on key blocks, nothing written, also per group.
* ``keys_at_positions``: only the keys at a few positions, so that a cut of the
  list becomes a plain filter on the key that reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefloom.session import scratch_folder

BLOCK_BITS = 12  # a block spans 4,096 keys, so it holds at most that many rows
SPAN_BITS = 16  # units of one level in a unit of the next
SPAN_LEVELS = 2  # levels above the blocks, below the top


def _block(key: str) -> Column:
    # never NULL, so that no plan branch gets a null check of its own and equal
    # shuffles stay recognisable as equal
    return F.coalesce(F.shiftright(F.col(key), BLOCK_BITS), F.lit(0))


def block_offsets(
    df: DataFrame, key: str, groups: Sequence[str] = (), measures: dict[str, Column] | None = None
) -> DataFrame:
    """Per (group, block): rows in the block (``_n``) and, for rows and every
    measure, the total of the group's earlier blocks (``_before_<name>``). A NULL group stops the job.

    Running sums are taken level by level: inside spans of 65,536 blocks, inside
    spans of as many of those, and over what is left. With three levels no task
    sees more than 65,536 rows of one span or 1,048,576 of the top, whatever 64-bit
    keys there are and however many rows one group holds.
    """
    groups = list(groups)
    measures = {"n": F.lit(1), **(measures or {})}
    for g in groups:
        told = F.raise_error(F.lit(f"NULL in group column {g}")).cast(df.schema[g].dataType)
        df = df.withColumn(g, F.when(F.col(g).isNull(), told).otherwise(F.col(g)))
    sizes = df.groupBy(*groups, _block(key).alias("_block")).agg(
        *[F.sum(c).alias(f"_{m}") for m, c in measures.items()]
    )
    return _running(sizes, "_block", groups, list(measures), SPAN_LEVELS)


def _running(
    sizes: DataFrame, unit: str, groups: list[str], measures: list[str], levels: int
) -> DataFrame:
    """Add ``_before_<m>``: the sum of ``_<m>`` over the group's earlier units."""
    def earlier(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    zero = F.lit(0)
    if levels == 0:
        top = earlier(Window.partitionBy(*groups).orderBy(unit))
        return sizes.select(
            "*", *[F.coalesce(F.sum(f"_{m}").over(top), zero).alias(f"_before_{m}") for m in measures]
        )
    span = f"{unit}_span"
    sizes = sizes.withColumn(span, F.shiftright(unit, SPAN_BITS))
    totals = sizes.groupBy(*groups, span).agg(*[F.sum(f"_{m}").alias(f"_{m}") for m in measures])
    starts = _running(totals, span, groups, measures, levels - 1).select(
        *groups, span, *[F.col(f"_before_{m}").alias(f"_start_{m}") for m in measures]
    )
    within = earlier(Window.partitionBy(*groups, span).orderBy(unit))
    inside = sizes.select(
        "*", *[F.coalesce(F.sum(f"_{m}").over(within), zero).alias(f"_in_{m}") for m in measures]
    )
    return inside.join(starts, [*groups, span]).select(
        *groups, unit, *[f"_{m}" for m in measures],
        *[(F.col(f"_start_{m}") + F.col(f"_in_{m}")).alias(f"_before_{m}") for m in measures],
    )


def number_rows(
    df: DataFrame,
    key: str,
    groups: Sequence[str] = (),
    number: str = "pos",
    first: int = 0,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Number the rows of each group (or of the table) by ``key`` from ``first``.

    ``running`` adds, per name, the sum of that column over the group up to and
    including the row. ``key`` is a unique integer and group columns are not
    NULL. The wide rows are shuffled once, by (group, block).
    """
    groups = list(groups)
    running = running or {}
    blocked = df.withColumn("_block", _block(key))
    up_to_here = Window.partitionBy(*groups, "_block").orderBy(key).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = blocked.select(
        "*",
        F.row_number().over(up_to_here).cast("bigint").alias("_local_n"),
        *[F.sum(c).over(up_to_here).alias(f"_local_{m}") for m, c in running.items()],
    )
    placed = local.join(block_offsets(df, key, groups, running), [*groups, "_block"])
    return placed.select(
        *df.columns,
        (F.col("_before_n") + F.col("_local_n") + (first - 1)).alias(number),
        *[(F.col(f"_before_{m}") + F.col(f"_local_{m}")).alias(m) for m in running],
    )


def first_rows(df: DataFrame, n: int, key: str, groups: Sequence[str], number: str) -> DataFrame:
    """The first ``n`` rows of each group by ``key``, numbered from 1.

    Blocks that start after the n-th row of their group are dropped by a join on
    the block totals before any row is sorted.
    """
    groups = list(groups)
    wanted = block_offsets(df, key, groups).filter(F.col("_before_n") < n)
    by_key = Window.partitionBy(*groups, "_block").orderBy(key)
    return (
        df.withColumn("_block", _block(key))
        .join(wanted, [*groups, "_block"])
        .withColumn(number, F.col("_before_n") + F.row_number().over(by_key))
        .filter(F.col(number) <= n)
        .select(*df.columns, number)
    )


def keys_at_positions(df: DataFrame, key: str, positions: Iterable[int]) -> dict[int, int]:
    """Key of the row at each 0-based position; positions past the end are left out.

    The driver receives one row per wanted position and no more.
    """
    positions = sorted(set(positions))
    if not positions:
        return {}
    keys = df.select(key)
    holds = [
        (F.col("_before_n") <= p) & (F.col("_before_n") + F.col("_n") > p) for p in positions
    ]
    offsets = block_offsets(keys, key)
    hit = offsets.filter(_any(holds)).select("_block", "_before_n").collect()
    starts = {r["_block"]: r["_before_n"] for r in hit}
    if not starts:
        return {}
    width = 1 << BLOCK_BITS
    spans = [F.col(key).between(b * width, b * width + width - 1) for b in starts]
    numbered = keys.filter(_any(spans)).withColumn("_block", _block(key)).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_block").orderBy(key)) - 1
    )
    exact = [
        (F.col("_block") == b) & (F.col("_rn") == p - start)
        for b, start in starts.items()
        for p in positions
        if p >= start
    ]
    rows = numbered.filter(_any(exact)).collect()
    return {starts[r["_block"]] + r["_rn"]: r[key] for r in rows}


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def with_position(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "pos",
    partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Dense positions 0..n-1 by unique ``order_cols`` of any type.

    The sorted rows are written once, to ``path`` or the shared scratch folder:
    a range shuffle samples its input, so two evaluations could place a row
    differently, and a lost executor must not change positions. The folder is
    the caller's to remove. The offsets are
    one row per written partition. Later filters on the written order columns
    skip row groups, since the files are in order.
    """
    spark = df.sparkSession
    path = path or scratch_folder(spark, "positions")
    # without a number Spark deals by the session's setting and joins small partitions
    dealt = df.repartitionByRange(*([partitions] if partitions else []), *order_cols)
    (
        dealt.sortWithinPartitions(*order_cols)
        .withColumn("_slot", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return read_positions(spark, path, name)


def read_positions(spark, path: str, name: str = "pos") -> DataFrame:
    """Open a table written by ``with_position``."""
    written = spark.read.parquet(path)
    part = F.shiftright("_slot", 33)
    counts = written.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per written partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        written.withColumn("_part", part)
        .join(starts, "_part")
        .select(
            (F.col("_start") + in_part).alias(name),
            *[c for c in written.columns if c != "_slot"],
        )
    )

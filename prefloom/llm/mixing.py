"""Mixing sources to target weights along a curriculum.

Targets. Sources in code point order (null last) take the weights in turn and
share all words by weight; a source gives ``most`` times its size at most, the
excess is shared again by weight until none is above. That fixed point has a
closed form: with sources sorted by cap / weight, the common rate is the largest
of (total - caps before) / (weights from here on).

Curriculum. The density of a source over training time t in [0, 1] is linear,
``1 + slope * (2t - 1)``: its weight rises, falls or stays. Integrated, the source
has given ``target * (t + slope * (t * t - t))`` words by time t. Its documents,
in an order by digest of doc_id, fill this demand pass after pass; inverting the
demand at a document's first word gives its position, and documents are range-sorted by
position. The demand ends at the target, so the last pass ends inside a document,
whose ``taken`` is the part before the end.

Running sums need no task to see a whole source: rows are summed inside blocks of
the digest, blocks are summed per source.

Defined results: a null text has size 0; documents of size 0 take nothing and have
no position; a null source is a source; a null doc_id is a value like any other;
equal doc_ids are ordered by size; an empty table gives an empty result. Other
columns are carried along, whatever their names; in a plan, a given column with the name of a
result (source_size, target, taken, positions) gives way to it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefloom.llm.tables import stored
from prefloom.llm.words import WORD

WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)  # low weights fade out, high weights fade in
MOST = 3
BLOCK_ROWS = 20_000
STEPS = 1_000_000  # positions are in millionths of the training
OWN = ("doc_id", "source", "size")
RESULTS = ("source_size", "target", "taken", "positions")


def size_of(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, most: int = MOST) -> DataFrame:
    """(source, source_size) of every source -> also target and slope."""
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1
    named = sizes.withColumn("turn", turn.cast("int")).select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), F.col("turn")).cast("long").alias("weight"),
        F.element_at(F.array(*map(F.lit, slopes)), F.col("turn")).cast("double").alias("slope"),
        (F.col("source_size") * most).alias("cap"),
    )
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    return (
        named.withColumn("rate", rate)
        .withColumn("rate", F.max("rate").over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("weight") * F.col("rate")).alias("target"),
            "slope",
        )
    )


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, slopes: Sequence[float] = SLOPES, most: int = MOST) -> DataFrame:
    """``docs`` (doc_id, source, size and any others) with source_size, target,
    taken and the positions of its passes; see the module. Read twice: store costly
    inputs first."""
    # one block for every BLOCK_ROWS rows, in steps of 16: leading digits of the digest
    digits = min(15, max(0, math.ceil(math.log(max(1, docs.count() / BLOCK_ROWS), 16))))
    order = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    given = [c for c in docs.columns if c not in RESULTS]
    others = {c: f"_given{i}" for i, c in enumerate(given) if c not in OWN}
    numbers = docs.select(*OWN, *[F.col(c).alias(name) for c, name in others.items()])
    dealt = numbers.withColumn("_order", order).withColumn("_block", F.shiftright("_order", 4 * (15 - digits)))
    blocks = dealt.groupBy("source", "_block").agg(F.sum("size").alias("_size"))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("source").alias("_source"),
        F.col("_block").alias("_of"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    shares = targets(blocks.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, slopes, most)
    offsets = offsets.join(shares, F.col("_source").eqNullSafe(F.col("source"))).drop("source")

    inside = Window.partitionBy("source", "_block").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_of")))
        .withColumn("_begin", F.col("_before") + F.col("_inside"))
    )
    demand = F.floor("target").cast("long")
    begins = [F.col("_begin") + F.col("source_size") * turn for turn in range(most)]  # words before it, per pass
    taken = [F.least(F.greatest(demand - begin, F.lit(0)), F.col("size")) for begin in begins]
    positions = [F.when(part > 0, _position(begin)) for part, begin in zip(taken, begins, strict=True)]
    return placed.select(
        *[F.col(others.get(c, c)).alias(c) for c in given],
        "source_size",
        "target",
        sum(taken, F.lit(0)).cast("long").alias("taken"),
        F.array_compact(F.array(*positions)).alias("positions"),
    )


def _position(begin: Column) -> Column:
    """When the source's demand reaches ``begin`` words: the inverse of its integral."""
    done, flat = F.try_divide(begin, F.col("target")), 1 - F.col("slope")
    time = 2 * done / (flat + F.sqrt(flat * flat + 4 * F.col("slope") * done))
    # at the very start of a source that begins with weight 0 both terms vanish
    return F.when(begin == 0, F.lit(0)).otherwise(F.floor(time * STEPS)).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document, sorted by training position."""
    sized = stored(docs.select("doc_id", "source", size_of().alias("size")), "sizes")
    planned = plan_mix(sized).drop("source").withColumn("position", F.get("positions", F.lit(0))).drop("positions")
    return planned.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents themselves, whole and in training order: a document appears
    ``taken / size`` times, rounded, and not at all if that is 0. Columns as given."""
    columns = docs.columns
    kept = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), "doc_id", "source", size_of().alias("size"))
    kept = stored(kept.withColumn("_id", F.monotonically_increasing_id()), "sized")
    # planned on the numbers alone, so that the texts are shuffled for the join and the sort only
    planned = plan_mix(kept.select("_id", "doc_id", "source", "size"))
    copies = F.coalesce(F.round(F.try_divide("taken", "size")).cast("int"), F.lit(0))
    places = planned.select("_id", F.explode(F.slice("positions", F.lit(1), copies)).alias("position"))
    return kept.select("_id", "doc_id", "_row").join(places, "_id").orderBy("position", "doc_id").select("_row.*")

"""Near-duplicate embeddings by randomised-rotation binary codes.

Equal vectors collapse to one with a number of copies. A unit vector is rotated
at random; the signs of the result are its code, and the inner product of code and
rotated vector is stored with it as the correction factor. ``<code, rotated q> / factor``
is an unbiased estimate of the cosine with any q, and the factor gives a bound for its
error: pairs whose upper bound stays below the threshold are dropped, all others
are computed again in double precision from the vectors, and only those count.

Pairs meet in buckets: bits of further rotations, as many as leave some ``FILL`` vectors in
a bucket, in as many tables as find a pair at the threshold with probability ``RECALL``. A
pair counts in the first table that has it. Buckets over ``BLOCK`` vectors are
compared in pairs of blocks, so that no task gets a large bucket.

What goes to the buckets are codes, factors and the rotated vectors in ``LEVELS`` steps,
each vector being the code of one estimate and the other side of the next. A block
pair returns which of its vectors are in a pair that either bound leaves open; these alone are
joined with their vectors and computed exactly, again in block pairs, which return
links and one root per vector, never the pairs.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component link with nothing and are their own component; vectors of other lengths
never link; a null vec_id takes part; an empty table gives an empty result; columns
other than vec_id and embedding are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.tables import components, drop, per_group, stored

THRESHOLD = 0.95
RECALL = 0.999
FILL = 16
BLOCK = 512
CONFIDENCE = 3.0  # the bound in standard deviations of the estimate
LEVELS = 16  # half a byte per component
LAST = (1 << 63) - 1


def plan_buckets(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a bucket and number of tables."""
    bits = max(8, math.ceil(math.log2(max(2, vectors) / FILL)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for all tasks."""
    q, r = np.linalg.qr(np.random.default_rng([size, seed]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs (0, 1) of the rotated vectors, and their correction factors."""
    turned = unit @ rotation(unit.shape[1], 0).T
    return turned > 0, np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def estimate(signs: np.ndarray, factors: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded vectors (rows) with ``unit`` (columns), and the bound
    of their error per row."""
    return _estimated(signs, factors, unit @ rotation(unit.shape[1], 0).T)


def _estimated(signs: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = turned.shape[1]
    code = np.where(signs, 1.0, -1.0) / math.sqrt(size)
    spread = np.sqrt(np.maximum(0.0, 1 - factors**2)) / factors / math.sqrt(max(1, size - 1))
    return (code @ turned.T) / factors[:, None], CONFIDENCE * spread


def in_levels(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors in ``LEVELS`` steps of their own, two components a byte, and
    (lowest, step) of each."""
    lowest = turned.min(axis=1)
    step = (turned.max(axis=1) - lowest) / (LEVELS - 1)
    level = np.rint((turned - lowest[:, None]) / np.where(step > 0, step, 1.0)[:, None]).astype(np.uint8)
    if level.shape[1] % 2:
        level = np.pad(level, ((0, 0), (0, 1)))
    return level[:, ::2] << 4 | level[:, 1::2], lowest, step


def open_pairs(signs: np.ndarray, factors: np.ndarray, packed: np.ndarray, lowest: np.ndarray, step: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the bound of either estimate of a pair reaches the threshold, for all pairs."""
    size = signs.shape[1]
    level = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(packed), -1)[:, :size]
    cosine, bound = _estimated(signs, factors, lowest[:, None] + level * step[:, None])
    rounding = CONFIDENCE * step[None, :] / math.sqrt(12) / factors[:, None]
    reach = cosine + bound[:, None] + rounding >= threshold
    return reach | reach.T


def bucket_signs(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Signs (0, 1) of further rotations, ``bits`` for each table."""
    size = unit.shape[1]
    turns = math.ceil(bits * tables / size)
    return np.concatenate([unit @ rotation(size, t + 1).T > 0 for t in range(turns)], axis=1)[:, : bits * tables]


def as_numbers(signs: np.ndarray, bits: int) -> np.ndarray:
    """One number per table."""
    return (signs.reshape(len(signs), -1, bits).astype(np.int64) << np.arange(bits)).sum(axis=2)


def bucket_codes(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Per vector one number per table."""
    return as_numbers(bucket_signs(unit, bits, tables), bits)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # keeps the norm finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


CODED = "id long, size int, signs binary, factor double, levels binary, lowest double, step double, codes binary, buckets array<long>"


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _code_rows(bits: int, tables: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                lists = batch.column("embedding").to_pylist()
                sizes = np.array([len(v) for v in lists])
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    unit = _unit(np.array([lists[i] for i in at], dtype=np.float64))
                    signs, factors = encode(unit)
                    levels, lowest, step = in_levels(unit @ rotation(size, 0).T)
                    further = bucket_signs(unit, bits, tables)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(pa.array(at)),
                            pa.array(np.full(len(at), size, dtype=np.int32)),
                            _binary(np.packbits(signs, axis=1)),
                            pa.array(factors),
                            _binary(levels),
                            pa.array(lowest),
                            pa.array(step),
                            _binary(np.packbits(further, axis=1)),
                            # vectors of other lengths are in other buckets
                            pa.array(list(as_numbers(further, bits) ^ (int(size) << 40)), pa.list_(pa.int64())),
                        ],
                        names=[c.split()[0] for c in CODED.split(", ")],
                    )

    return rows


def _sides(rows: pa.Table, allowed: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Of the ``allowed`` pairs those that have one row on each side of the block pair, each
    once, and that no earlier table has."""
    low, high, table = (rows.column(c)[0].as_py() for c in ("low", "high", "table"))
    block = rows.column("block").to_numpy()
    i, j = np.nonzero(allowed & (block == low)[:, None] & (block == high)[None, :])
    if low == high:
        i, j = i[i < j], j[i < j]
    codes = as_numbers(np.unpackbits(_bytes(rows.column("codes")), axis=1)[:, : bits * tables], bits)
    fresh = np.ones(len(i), dtype=bool)
    for t in range(table):
        fresh &= codes[i, t] != codes[j, t]
    return np.stack([i[fresh], j[fresh]])


GROUP = ["table", "bucket", "low", "high"]
OPEN = "table int, bucket long, low int, high int, block int, id long, codes binary"


def _still_open(threshold: float, bits: int, tables: int):
    """The rows of one pair of blocks that are in a pair which the bounds leave open."""

    def found(rows: pa.Table) -> pa.Table | None:
        rows = rows.sort_by("id")
        signs = np.unpackbits(_bytes(rows.column("signs")), axis=1)[:, : rows.column("size")[0].as_py()].astype(bool)
        factors, lowest, step = (rows.column(c).to_numpy() for c in ("factor", "lowest", "step"))
        pairs = _sides(rows, open_pairs(signs, factors, _bytes(rows.column("levels")), lowest, step, threshold), bits, tables)
        return rows.select([c.split()[0] for c in OPEN.split(", ")]).take(pa.array(np.unique(pairs)))

    return found


def _linked(threshold: float, bits: int, tables: int):
    """Links of one pair of blocks, in double precision."""

    def linked(rows: pa.Table) -> pa.Table | None:
        rows = rows.sort_by("id")
        unit = _unit(np.array(rows.column("embedding").to_pylist(), dtype=np.float64))
        i, j = _sides(rows, unit @ unit.T >= threshold - 1e-9, bits, tables)
        exact = np.einsum("ij,ij->i", unit[i], unit[j])
        i, j = i[exact >= threshold], j[exact >= threshold]
        if not len(i):
            return None
        ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
        links = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
        root = np.arange(len(ids))
        while True:  # smallest neighbour, again and again
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            if (new == root).all():
                break
            root = new
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[root][some]})

    return linked


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = F.size("embedding") > 0
    fine &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine &= F.exists("embedding", lambda x: x != 0)
    fine = F.coalesce(fine, F.lit(False))
    distinct = stored(
        vectors.filter(fine)
        .groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.coalesce("vec_id", F.lit(LAST))).alias("first"))
        .withColumn("id", F.monotonically_increasing_id()),
        "vectors",
    )
    bits, tables = plan_buckets(distinct.count(), threshold, recall)
    coded = stored(distinct.select("id", "embedding").mapInArrow(_code_rows(bits, tables), CODED), "codes")
    places = coded.select("id", F.posexplode("buckets").alias("table", "bucket"))
    sizes = places.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    # few, and stored: Spark sees their size and broadcasts them if they are small
    large = stored(sizes.select("table", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large")
    dealt = (
        coded.select("*", F.posexplode("buckets").alias("table", "bucket"))
        .drop("buckets")
        .join(large, ["table", "bucket"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    still = stored(per_group(dealt, GROUP, _still_open(threshold, bits, tables), OPEN), "open")
    drop(coded, large)
    exact = still.join(distinct.select("id", "copies", "embedding"), "id")
    linked = stored(per_group(exact, GROUP, _linked(threshold, bits, tables), "id long, links long, root long"), "linked")
    drop(still)
    classes = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()).join(distinct.select("id", "first"), "id")
    named = classes.groupBy("component").agg(F.min("first").alias("least"))
    found = (
        distinct.join(linked.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
        .join(classes.select("id", "component").join(named, "component"), "id", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("least", "first").alias("least"))
    )
    rows = vectors.filter(fine).join(found, "embedding").select(
        "vec_id", F.col("n").cast("long").alias("n_links"), F.nullif(F.col("least"), F.lit(LAST)).alias("component_id")
    )
    alone = vectors.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

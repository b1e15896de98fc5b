"""Similarity join of documents on word shingles by chosen paths.

A document is the set of its shingles (five words; a shorter text is one shingle).
Documents with equal sets collapse to one set with a number of copies.

1. Every set is embedded as ``COORDINATES`` MinHash values; two sets agree in a
   coordinate with a probability of their Jaccard similarity.
2. Chosen paths. A node of the recursion chooses each coordinate with probability
   ``1 / (threshold * COORDINATES)``, by a hash of its path, and a set goes to the child
   of its value there: similar sets survive together, others part. Buckets of up to ``SMALL``
   sets are compared as they are, larger ones split again, ``DEPTH`` times at most.
   A level is one expansion in tasks and one count per path. Runs with other
   hashes repeat until a pair at the threshold is found with probability ``RECALL``.
3. Sets of a bucket whose values agree as those of similar sets may are joined to
   candidate clusters; a bucket still large at the last level is one.
4. Clusters are verified exactly on whole shingle sets, all pairs, in pairs of
   blocks of bounded size, so that no task gets a large cluster and no pair is
   emitted: a block pair returns links and one root per member.
5. Classes are the components of the verified links.

Shingles are compared by 64-bit hashes, sets by 128 bits. Defined results: documents
without words link with nothing; copies are links; null doc_ids take part, a class
is named by its smallest doc_id; an empty table gives an empty result; other columns are not
used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.tables import components, drop, free_name, per_group, stored
from prefloom.llm.words import ODD, mix, shingles, slices, split_words

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9995
COORDINATES = 64
DEPTH = 4
SMALL = 64
SLACK = 0.2  # four standard deviations of the estimate from 64 values
BLOCK_SETS = 256
BLOCK_SHINGLES = 500_000

SETS = "doc_id long, rid long, k1 long, k2 long, size long, sketch binary"


def runs_needed(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``:
    a run keeps it through every level like a branching process with mean 1."""
    together = 1.0
    for _ in range(depth):
        together = 1 - math.exp(-together)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def _unsigned(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(ODD) + np.uint64(seed))


def sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values of all sets that are not empty, one row each."""
    full = np.flatnonzero(first[1:] > first[:-1])
    out = np.zeros((len(full), COORDINATES), dtype=np.uint32)
    for j, factor in enumerate(_unsigned(COORDINATES, 5) | np.uint64(1)):
        out[:, j] = np.minimum.reduceat((hashes * factor) >> np.uint64(32), first[:-1][full]) if len(full) else 0
    return out


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            hashes, first = shingles(split_words(batch.column("text")), SHINGLE)
            values = sketches(hashes, first)
            rows, k = [], 0
            for i in range(batch.num_rows):
                own = np.unique(hashes[first[i] : first[i + 1]])
                a = int(mix(own).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0
                b = int(mix(own ^ np.uint64(ODD)).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0
                rows.append((a, b, len(own), values[k].tobytes() if len(own) else None))
                k += bool(len(own))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rid"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))],
                names=[c.split()[0] for c in SETS.split(", ")],
            )


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES).astype(np.uint64)


def _children(paths: np.ndarray, values: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows of paths and values: rows and paths of all children."""
    names = _unsigned(COORDINATES, 11)
    limit = np.uint64(int(2**64 / (threshold * COORDINATES)))
    keys = mix(paths[:, None] ^ names[None, :])
    row, coordinate = np.nonzero(keys < limit)
    return row, mix(keys[row, coordinate] + values[row, coordinate] * np.uint64(ODD))


def _first_level(runs: int, threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _unsigned(runs, 23)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                ids, values = batch.column("id").to_numpy(), _values(batch.column("sketch"))
                row, path = _children(np.tile(roots, len(ids)), np.repeat(values, runs, axis=0), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[row // runs])], names=["path", "id"])

    return rows


def _next_level(threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                ids, values = batch.column("id").to_numpy(), _values(batch.column("sketch"))
                row, path = _children(batch.column("path").to_numpy().view(np.uint64), values, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids[row])], names=["path", "id"])

    return rows


def _roots(n: int, links: Iterator[tuple[int, int]]) -> list[int]:
    """The smallest index each index is linked to, directly or not."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _bucket_links(threshold: float):
    """Links (a, b) of one small bucket (path, id, brief): candidates by agreement."""

    def links(bucket: pa.Table) -> pa.Table | None:
        bucket = bucket.sort_by("id")
        ids = bucket.column("id").to_numpy()
        values = np.frombuffer(b"".join(bucket.column("brief").to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)
        if len(ids) == 2 and (values[0] == values[1]).mean() < threshold - SLACK:
            return None
        alike = (values[:, None, :] == values[None, :, :]).mean(axis=2) >= threshold - SLACK
        root = _roots(len(ids), zip(*np.nonzero(np.triu(alike, 1)), strict=True))
        own = [i for i, r in enumerate(root) if r != i]
        return pa.table({"a": pa.array(ids[own], pa.int64()), "b": pa.array(ids[[root[i] for i in own]], pa.int64())})

    return links


def candidate_links(sets: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Links (a, b) whose components hold every pair of similar sets (id, sketch), stored."""
    level = stored(
        sets.select("id", "sketch").mapInArrow(_first_level(runs_needed(recall, DEPTH), threshold), "path long, id long"), "paths"
    )
    found = []
    for depth in range(1, DEPTH + 1):
        sizes = stored(level.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).filter("n > 1"), "buckets")
        small = level.join(sizes.filter(F.col("n") <= SMALL).select("path"), "path")
        brief = F.expr(f"unhex(array_join(transform(sequence(0, {COORDINATES - 1}), i -> hex(substring(sketch, 4 * i + 1, 1))), ''))")
        members = small.join(sets.select("id", brief.alias("brief")), "id")
        found.append(stored(per_group(members, ["path"], _bucket_links(threshold), "a long, b long").distinct(), "links"))
        if sizes.filter(F.col("n") > SMALL).isEmpty():
            drop(level, sizes)
            break
        large = level.join(sizes.filter(F.col("n") > SMALL).select("path", "least"), "path")
        if depth == DEPTH:
            found.append(stored(large.filter("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct(), "links"))
            drop(level, sizes)
        else:
            last, level = level, stored(
                large.select("path", "id").join(sets.select("id", "sketch"), "id").mapInArrow(_next_level(threshold), "path long, id long"),
                "paths",
            )
            drop(last, sizes)
    links = stored(reduce(DataFrame.union, found).distinct(), "candidates")
    drop(*found)
    return links


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            hashes, first = shingles(split_words(batch.column("text")), SHINGLE)
            own = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first, first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "copies", "cluster", "blocks", "block")), pa.array(own, pa.list_(pa.int64()))],
                names=["id", "copies", "cluster", "blocks", "block", "shingles"],
            )


def _verify(threshold: float):
    """Links of one pair of blocks: copies linked and a root, per member."""

    def verified(members: pa.Table) -> pa.Table:
        members = members.sort_by("id")
        ids, copies = members.column("id").to_numpy(), members.column("copies").to_numpy()
        block, pair = members.column("block").to_numpy(), (members.column("low")[0].as_py(), members.column("high")[0].as_py())
        sets = members.column("shingles").combine_chunks()
        first = sets.offsets.to_numpy()
        size = np.diff(first)
        _, number = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        number, first = number[: first[-1] - first[0]], first - first[0]
        links, pairs = np.zeros(len(ids), np.int64), []
        mark = np.zeros(len(number), np.int32)
        for i in range(len(ids)):
            if block[i] != pair[0]:
                continue
            mark[number[first[i] : first[i + 1]]] = 1
            shared = np.add.reduceat(mark[number], first[:-1])
            mark[number[first[i] : first[i + 1]]] = 0
            near = shared >= threshold * (size + size[i] - shared) - 1e-9
            near &= (block == pair[1]) & ((ids > ids[i]) if pair[0] == pair[1] else True)
            links[near] += copies[i]
            links[i] += copies[near].sum()
            pairs += [(i, j) for j in np.flatnonzero(near)]
        root = np.array(_roots(len(ids), pairs), dtype=np.int64)
        some = links > 0
        return pa.table({"id": ids[some], "links": links[some], "root": ids[root][some]})

    return verified


def near_documents(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, rid, class_id, class_rid, n_links) of every document, stored; ``rid``
    hashes doc_id and text, class_id and class_rid name the first document of the class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("rid"), "text")
    rows = stored(docs.mapInArrow(_set_rows, SETS), "sets")
    key = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "rid")
    sets = stored(
        rows.filter("size > 0")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.min(key).alias("least"), F.first("sketch").alias("sketch"))
        .withColumn("id", F.monotonically_increasing_id()),
        "distinct",
    )
    candidates = candidate_links(sets, threshold, recall)
    clusters = components(candidates)
    drop(candidates)
    # blocks of a cluster by hash: as many as its sets and shingles need
    members = clusters.join(sets.select("id", "copies", "size", "least"), "id")
    parts = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    members = members.join(parts, "component").select(
        "id", "copies", F.col("component").alias("cluster"), "blocks", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), F.col("least.rid").alias("rid")
    )
    texts = members.join(docs.select("rid", "text"), "rid").drop("rid")
    schema = "id long, copies long, cluster long, blocks int, block int, shingles array<long>"
    blocks = texts.mapInArrow(_shingle_rows, schema).dropDuplicates(["id"])
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    linked = stored(per_group(blocks, ["cluster", "low", "high"], _verify(threshold), "id long, links long, root long"), "linked")

    drop(clusters)
    stars = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = stars.join(sets.select("id", "least"), "id")
    named = classes.groupBy("component").agg(F.min("least").alias("first"))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    found = (
        sets.select("id", "k1", "k2", "copies", "least")
        .join(classes.select("id", "component").join(named, "component"), "id", "left")
        .join(links, "id", "left")
        .select("k1", "k2", F.coalesce("first", "least").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    last = F.lit((1 << 63) - 1)
    result = rows.select("doc_id", "rid", "k1", "k2", "size").join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "rid",
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.nullif(F.col("first.doc"), last)).alias("class_id"),
        F.when(F.col("size") == 0, F.col("rid")).otherwise(F.col("first.rid")).alias("class_rid"),
        F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
    result = stored(result, "classes")
    drop(rows, sets, linked, stars)
    return result


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The first document of every class, all columns as given. Documents without
    words all stay, unless they are the same row again."""
    columns, rid = docs.columns, free_name(docs, "_rid")
    first = near_documents(docs, threshold).filter("rid = class_rid").select(F.col("rid").alias(rid)).distinct()
    rows = docs.withColumn(rid, F.xxhash64(F.col("doc_id").cast("long"), F.col("text")))
    return rows.join(first, rid).dropDuplicates([rid]).select(*columns)

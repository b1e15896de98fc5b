"""Rankings of many batches, stored in levels.

A batch must not read the whole history to learn which of its keys are ranked already. So
batches are merged like the digits of a binary number: after n batches there is one range
of batches per binary digit 1 of n, ``level=L/start=S`` holding the batches S to S + 2**L with
one row per key. A row is rewritten once per level, and at most log2(n) + 1 ranges are alive.
Inside a range, rows lie in buckets by the leading bits of their key, one bit more per
level, so that buckets keep their size while ranges double; a batch opens only the buckets of
its own keys, some rows per key and level.

A merge shuffles one slice of the keys after the other, so that what it shuffles is small beside the
ranges. The texts of a row are one column, ``texts``: instruction, input, reference answer, responses.
Responses that quote the instruction then lie beside it where Parquet compresses. Ranges written
before with a column for each are read too, and merged into this form.

Which ranges are alive follows from the number of batches alone, so there is no list to keep
in step. What a merge replaced is deleted when the next batch begins: a batch that was cut off
finds all it needs when it is repeated under the same number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prefloom.operators.completion import Responder, spread
from prefloom.operators.preference import last_orders, last_per_key, with_rank_prompt
from prefloom.operators.skew import anti_join
from prefloom.operators.staging import shuffles_freed
from prefloom.session import scratch_folder
from prefloom.sources import shared
from prefloom.sources.records import delete_path, path_bytes
from prefloom.streaming.ledger import ranked_rows, read_replies, record_replies, with_identity
from prefloom.streaming.ranking import RESULT_FIELDS

BASE_BITS = 4  # bits of a key that choose its bucket at level 0
MOST_BITS = 16
SLICE_BYTES = 16 << 20  # stored bytes of a merge that are shuffled at once
MOST_SLICES = 16  # by the first digit of the key
ROW_GROUP = 16 << 20  # rows come in the order of their keys, so that a slice opens few row groups

STORED = f"{RESULT_FIELDS}, batch bigint"
COLUMNS = [field.split()[0] for field in STORED.split(", ")]
TEXTS = ["instruction", "input", "ground_truth"]
WIDE = [*TEXTS, "responses"]
PACKED = "texts array<string>, n_responses int"


def live_ranges(batches: int) -> list[tuple[int, int]]:
    """(level, first batch) of the ranges that hold the first ``batches`` batches, in order."""
    ranges, start = [], 0
    for level in reversed(range(batches.bit_length())):
        if batches >> level & 1:
            ranges.append((level, start))
            start += 1 << level
    return ranges


def _folder(store: str, level: int, start: int) -> str:
    return f"{store}/level={level}/start={start:010d}"


def _bits(level: int, base_bits: int) -> int:
    return min(base_bits + level, MOST_BITS)


def prefix(key: str = "key") -> Column:
    """The first 16 bits of a key, which is hexadecimal."""
    return F.conv(F.substring(key, 1, MOST_BITS // 4), 16, 10).cast("int")


def _packed() -> list[Column]:
    none = F.array().cast("array<string>")
    return [
        F.concat(F.array(*TEXTS), F.coalesce("responses", none)).alias("texts"),
        F.when(F.col("responses").isNotNull(), F.size("responses")).alias("n_responses"),
    ]


def pack(rows: DataFrame) -> DataFrame:
    """``rows`` with all their texts in the one column ``texts``."""
    return rows.select(*[c for c in rows.columns if c not in WIDE], *_packed())


def unpack(rows: DataFrame) -> DataFrame:
    """What ``pack`` was given."""
    texts = [F.get("texts", F.lit(i)).alias(c) for i, c in enumerate(TEXTS)]
    n = F.col("n_responses")
    responses = F.when(n.isNotNull(), F.slice("texts", len(TEXTS) + 1, F.coalesce(n, F.lit(0))))
    return rows.select(*[c for c in rows.columns if c not in ("texts", "n_responses")], *texts, responses.alias("responses"))


def _read(spark: SparkSession, store: str, ranges: Sequence[tuple[int, int]], prefixes: Sequence[int] | None, base_bits: int) -> DataFrame:
    """Packed rows of the ranges."""
    narrow = [c for c in COLUMNS if c not in WIDE]
    found = pack(spark.createDataFrame([], STORED)).select(*narrow, "texts", "n_responses")
    for level, start in ranges:
        folder = _folder(store, level, start)
        if not shared.exists(f"{folder}/_SUCCESS"):
            raise ValueError(f"{folder} is missing: batches are numbered from 0 without gaps")
        if not shared.names(folder):
            continue  # batches without a row
        rows = spark.read.schema(f"{STORED}, {PACKED}, bucket int").parquet(folder)
        if prefixes is not None:
            drop = MOST_BITS - _bits(level, base_bits)
            rows = rows.filter(F.col("bucket").isin(sorted({p >> drop for p in prefixes})))
        # a row that was written before texts were packed has none
        texts, n = (F.when(F.col("texts").isNull(), p).otherwise(F.col(c)).alias(c) for p, c in zip(_packed(), ("texts", "n_responses")))
        found = found.union(rows.select(*narrow, texts, n))
    return found


def history(spark: SparkSession, store: str, batch: int, prefixes: Sequence[int] | None = None, base_bits: int = BASE_BITS) -> DataFrame:
    """Rows of the batches before ``batch``, from the buckets of the given key prefixes or from
    all. A key may be in several ranges."""
    return unpack(_read(spark, store, live_ranges(batch), prefixes, base_bits)).select(*COLUMNS)


def read_store(spark: SparkSession, store: str, batches: int | None = None, base_bits: int = BASE_BITS) -> DataFrame:
    """One row per key after ``batches`` batches, by default all finished ones: the last
    ranking, or the last failure of a key that never got one."""
    if batches is None:
        batches = finished_batches(store)
    return last_per_key(history(spark, store, batches, None, base_bits), prefer_success=True)


def finished_batches(store: str) -> int:
    ends = [0]
    for level in (n for n in shared.names(store) if n.startswith("level=")):
        for start in shared.names(f"{store}/{level}"):
            if shared.exists(f"{store}/{level}/{start}/_SUCCESS"):
                ends.append(int(start.removeprefix("start=")) + (1 << int(level.removeprefix("level="))))
    return max(ends)


def append(rows: DataFrame, store: str, batch: int, base_bits: int = BASE_BITS) -> None:
    """Add the results of ``batch``, merged with the ranges that it completes."""
    spark = rows.sparkSession
    done = batch + 1
    level = (done & -done).bit_length() - 1
    start = done - (1 << level)
    merged = [r for r in live_ranges(batch) if r[1] >= start]
    earlier = _read(spark, store, merged, None, base_bits)
    # computed once, and read slice by slice
    new, last = (scratch_folder(spark, n) for n in ("ranked", "last"))
    folder = _folder(store, level, start)
    own = pack(rows.withColumn("batch", F.lit(batch).cast("bigint")).select(*COLUMNS)).select(*earlier.columns)
    with shuffles_freed(spark):
        own.write.options(**{"compression": "zstd", "parquet.block.size": ROW_GROUP}).parquet(new)
    both = earlier.union(spark.read.schema(own.schema).parquet(new))
    winners = last_orders(both, prefer_success=True)
    slices = _slices(path_bytes(spark, new) + sum(path_bytes(spark, _folder(store, *r)) for r in merged))
    if slices > 1:
        # two numbers a row, read with every slice
        with shuffles_freed(spark):
            winners.write.parquet(last)
        winners = spark.read.schema(winners.schema).parquet(last)
    _merge(both, winners, slices, folder, _bits(level, base_bits))
    for path in (new, last):
        delete_path(spark, path)


def _slices(size: int) -> int:
    """Slices of the keys, a power of two, in which ``size`` bytes are merged."""
    return min(1 << max(0, -(-size // SLICE_BYTES) - 1).bit_length(), MOST_SLICES)


def _in_slice(number: int, slices: int) -> Column:
    """Keys by their first digit. Whatever a key is, it is in one slice; no key is in the first."""
    low, high = (f"{n * MOST_SLICES // slices:x}" for n in (number, number + 1))
    key, here = F.col("key"), F.lit(True)
    if number:
        here &= key >= low
    if number + 1 < slices:
        here &= key < high
    return here if number else here | key.isNull()


def _merge(rows: DataFrame, winners: DataFrame, slices: int, folder: str, bits: int) -> None:
    """Write the packed ``rows`` that ``winners`` names to their buckets, slice by slice. The folder
    is marked as a success with the last one."""
    bucket = F.shiftright(prefix(), MOST_BITS - bits).alias("bucket")
    for number in range(slices):
        own = rows.filter(_in_slice(number, slices)) if slices > 1 else rows
        placed = own.join(winners, winners.columns, "left_semi").select("*", bucket)
        if 1 << bits > slices:
            # few files for each of the buckets of a slice
            placed = placed.hint("rebalance", F.col("bucket"))
        options = {
            "compression": "zstd", "parquet.block.size": ROW_GROUP,
            "mapreduce.fileoutputcommitter.marksuccessfuljobs": str(number + 1 == slices).lower(),
        }
        with shuffles_freed(rows.sparkSession):
            placed.write.options(**options).mode("append" if number else "overwrite").partitionBy("bucket").parquet(folder)


def forget_replaced(store: str, batch: int) -> None:
    """Delete what the batch before replaced; it is finished, or ``batch`` would not begin."""
    if batch:
        for level, start in set(live_ranges(batch - 1)) - set(live_ranges(batch)):
            shared.remove(_folder(store, level, start))


def rank_stored(
    candidates: DataFrame,
    store: str,
    batch: int,
    responder_factory: Callable[[], Responder],
    *,
    key_cols: Sequence[str] = ("instruction",),
    strict_permutation: bool = False,
    prompt_fix: bool = False,
    partitions: int | None = None,
    base_bits: int = BASE_BITS,
    **options,
) -> None:
    """Rank the candidates whose key has no ranking in the batches before, as number ``batch``.

    Batches come in order, each repeated until it is finished. Replies are kept in
    the ledger of the store while the batch runs, so a repeated one asks only what is missing.
    A store is bound to its ``key_cols`` and ``base_bits``.
    """
    spark = candidates.sparkSession
    shared.bind(store, key_cols=list(key_cols), base_bits=base_bits)
    forget_replaced(store, batch)
    # the texts are hashed once, and the key is read without them afterwards
    folder, known = (scratch_folder(spark, n) for n in ("arrived", "known"))
    kept = pack(with_identity(candidates, key_cols).select("pos", "key", "seed", *WIDE))
    with shuffles_freed(spark):
        kept.write.option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(kept.schema).parquet(folder)
    arrived = unpack(stored)
    names = stored.select("pos", "key", "seed")
    # at most 2**MOST_BITS numbers
    prefixes = [r[0] for r in names.select(prefix()).distinct().collect()]
    done = history(spark, store, batch, prefixes, base_bits).filter(F.col("sorted_indices").isNotNull())
    # the buckets hold other keys too
    done = done.select("key").join(names.select("key"), "key", "left_semi")
    # found without the texts, which are shuffled once for the prompts and once for the results
    unranked = anti_join(names, done, "key", "pos")
    with shuffles_freed(spark):
        names.join(unranked, ["key", "seed"], "left_anti").select("key", "seed").write.parquet(known)
    # what is known is taken away: it is little where most rows are new, and a row without a key stays
    pending = arrived.join(spark.read.schema("key string, seed bigint").parquet(known), ["key", "seed"], "left_anti")
    ledger = f"{store}/ledger"
    own = read_replies(spark, ledger).filter((F.col("run") == batch) & (F.col("status") == "success"))
    unasked = pending.join(own, ["key", "seed"], "left_anti")
    prompts = with_rank_prompt(spread(unasked, partitions), prompt_fix=prompt_fix)
    with shuffles_freed(spark):
        record_replies(prompts, ledger, batch, responder_factory, **options)
    replies = read_replies(spark, ledger).filter(F.col("run") == batch)
    ranked = ranked_rows(pending, replies, strict_permutation)
    append(ranked, store, batch, base_bits)
    shared.remove(f"{ledger}/segments")
    for path in (folder, known):
        delete_path(spark, path)


def rank_store_stream(
    spark: SparkSession,
    candidates: str,
    schema: T.StructType,
    store: str,
    checkpoint: str,
    responder_factory: Callable[[], Responder],
    max_files: int = 1000,
    **options,
) -> StreamingQuery:
    """Rank the candidate files that arrived since the last start, batch by batch, then stop.

    A batch repeated after a failure has the same number and replaces what it left.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(candidates)

    def run(batch: DataFrame, batch_id: int) -> None:
        rank_stored(batch, store, batch_id, responder_factory, **options)

    return (
        arriving.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

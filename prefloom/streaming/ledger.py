"""Replies kept while a run is under way.

A run writes no table at its end: its tasks append every few replies as a segment, a small
file of their own, to the run's folder. Whatever stops the run, what was answered stays
answered. Layout of a ledger folder:

* ``segments/run=R/part=P/*.parquet``: replies of partition P in the order they came, from
  however many attempts. A segment is visible as a whole or not at all.
* ``settled/run=R``: the replies of a finished run as one table, which replaces its segments.

A reply belongs to a (key, seed): the hash of what was asked and a number that tells rows
with the same key apart. Attempts that run side by side, or a repeated run, may answer one twice;
``winners`` has exactly one for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefloom.operators.completion import Responder, ask, spread
from prefloom.operators.preference import instruction_key, parse_rankings, with_rank_prompt
from prefloom.sources import shared

SEED = 42
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FLUSH_ROWS = 256  # replies in one segment: what a lost attempt costs at most
ARROW_REPLY = pa.schema(
    [("key", pa.string()), ("seed", pa.int64()), ("reply", pa.string()), ("status", pa.string()), ("segment", pa.string())]
)
REPLY = "key string, seed bigint, reply string, status string, segment string"


def _folder(ledger: str, kind: str, run: int) -> str:
    return f"{ledger}/{kind}/run={run:08d}"


def answered_by(
    batches: Iterator[pa.RecordBatch], folder: str, responder_factory: Callable[[], Responder],
    batch_size: int, flush_rows: int,
) -> Iterator[int]:
    """Ask the prompts (key, seed, prompt) of one partition that its earlier attempts left open, and
    write the replies to ``folder``; yields the number of replies in each segment."""
    done = set()
    for table in shared.read_tables(folder, ["key", "seed", "status"]):
        rows = zip(*(table[c].to_pylist() for c in ("key", "seed", "status")))
        done.update((k, s) for k, s, status in rows if status == "success")
    responder, attempt, held = responder_factory(), uuid.uuid4().hex, []

    def flush() -> int:
        name = f"{attempt}-{len(written):08d}.parquet"
        columns = [pa.array(c, f.type) for c, f in zip(zip(*(r + (name,) for r in held)), ARROW_REPLY)]
        shared.publish(pa.Table.from_arrays(columns, schema=ARROW_REPLY), folder, name)
        written.append(len(held))
        held.clear()
        return written[-1]

    written: list[int] = []
    for batch in batches:
        # the texts of one call at a time, however many rows come at once
        names = list(zip(batch["key"].to_pylist(), batch["seed"].to_pylist()))
        open_rows = [i for i, name in enumerate(names) if name not in done]
        for start in range(0, len(open_rows), batch_size):
            own = open_rows[start : start + batch_size]
            keys, seeds = zip(*(names[i] for i in own))
            prompts = tuple(batch["prompt"][i].as_py() for i in own)
            replies = ask(responder, prompts, seeds)
            held += [(k, s, *r) for k, s, r in zip(keys, seeds, replies)]
            if len(held) >= flush_rows:
                yield flush()
    if held:
        yield flush()


def record_replies(
    asked: DataFrame,
    ledger: str,
    run: int,
    responder_factory: Callable[[], Responder],
    *,
    batch_size: int = 64,
    flush_rows: int = FLUSH_ROWS,
) -> int:
    """Ask ``asked`` (key, seed, prompt) and keep every reply in ``ledger``; says how many came.

    A repeated attempt of a task asks only what the segments of its partition lack, so
    ``asked`` has to deal its rows to the same partitions each time.
    """
    folder = _folder(ledger, "segments", run)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = f"{folder}/part={TaskContext.get().partitionId():08d}"
        for n in answered_by(batches, part, responder_factory, batch_size, flush_rows):
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    counts = asked.select("key", "seed", "prompt").mapInArrow(work, "n bigint")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint"))
    # prompts are long: a task holds those of one call, not 10,000
    spark = asked.sparkSession
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(batch_size))
    try:
        return total.first()[0]
    finally:
        spark.conf.set(ARROW_ROWS, before)


def read_replies(spark: SparkSession, ledger: str) -> DataFrame:
    """All replies with their ``run``: settled ones, and segments of runs under way or cut off."""
    settled = [r for r in shared.names(f"{ledger}/settled") if shared.exists(f"{ledger}/settled/{r}/_SUCCESS")]
    open_runs = [r for r in shared.names(f"{ledger}/segments") if r not in settled]
    found = spark.createDataFrame([], REPLY).withColumn("run", F.lit(0).cast("bigint"))
    for kind, runs in (("settled", settled), ("segments", open_runs)):
        # a task may just be making the folder of a run
        paths = [f"{ledger}/{kind}/{r}" for r in runs if shared.names(f"{ledger}/{kind}/{r}")]
        if paths:
            rows = spark.read.schema(REPLY).option("recursiveFileLookup", "true").parquet(*paths)
            number = F.regexp_extract("_metadata.file_path", r"/run=(\d+)/", 1).cast("bigint")
            found = found.union(rows.select(*ARROW_REPLY.names, number.alias("run")))
    return found


def winners(replies: DataFrame) -> DataFrame:
    """One reply per (key, seed): of the last run, an answer rather than a failure, and among
    equals that of the first segment by name."""
    rank = F.struct((-F.col("run")).alias("run"), (F.col("status") != "success").alias("failed"), "segment", "reply", "status")
    best = replies.groupBy("key", "seed").agg(F.min(rank).alias("_best"))
    return best.select(
        "key", "seed", (-F.col("_best.run")).alias("run"), F.col("_best.reply").alias("reply"), F.col("_best.status").alias("status")
    )


def settle(spark: SparkSession, ledger: str, run: int) -> None:
    """Replace the segments of a finished run by one table. Repeating it does no harm."""
    segments = _folder(ledger, "segments", run)
    if not shared.names(segments):
        return
    own = read_replies(spark, ledger).filter(F.col("run") == run)
    kept = winners(own).withColumn("segment", F.lit("settled"))
    # beside the segments, which are read until the table is complete
    kept.select(*ARROW_REPLY.names).write.mode("overwrite").parquet(_folder(ledger, "settled", run))
    shared.remove(segments)


def with_identity(rows: DataFrame, key_cols: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows with an instruction, their ``key`` and the ``seed`` that tells equal keys apart."""
    asked = rows.filter(F.col("instruction").isNotNull())
    return asked.withColumns({"key": instruction_key(key_cols), "seed": F.xxhash64("pos", F.lit(seed))})


def ranked_rows(candidates: DataFrame, replies: DataFrame, strict_permutation: bool = False) -> DataFrame:
    """Candidates (with ``key`` and ``seed``) and the ranking of their winning reply, if any."""
    best = winners(replies).withColumnRenamed("reply", "api_response")
    asked = candidates.drop("run", "status", "api_response")
    return parse_rankings(asked.join(best, ["key", "seed"], "left"), strict_permutation=strict_permutation)


def read_ledger(
    candidates: DataFrame, ledger: str, key_cols: Sequence[str] = ("instruction",), strict_permutation: bool = False
) -> DataFrame:
    """One row per candidate row: its winning reply, parsed, and the ``run`` it is from."""
    shared.bind(ledger, create=False, key_cols=list(key_cols))
    replies = read_replies(candidates.sparkSession, ledger)
    return ranked_rows(with_identity(candidates, key_cols), replies, strict_permutation)


def rank_recorded(
    candidates: DataFrame,
    ledger: str,
    run: int,
    responder_factory: Callable[[], Responder],
    *,
    key_cols: Sequence[str] = ("instruction",),
    strict_permutation: bool = False,
    prompt_fix: bool = False,
    partitions: int | None = None,
    **options,
) -> int:
    """Rank the candidate rows that have no usable ranking in ``ledger`` yet; says how many replies came.

    Every reply is kept as soon as its segment is full. A run that was cut off is
    simply started again under its number, and asks only what is missing. ``pos`` is
    unique; a ledger is bound to its ``key_cols``.
    """
    shared.bind(ledger, key_cols=list(key_cols))
    state = read_ledger(candidates, ledger, key_cols, strict_permutation)
    pending = spread(state.filter(F.col("sorted_indices").isNull()), partitions)
    came = record_replies(
        with_rank_prompt(pending, prompt_fix=prompt_fix), ledger, run, responder_factory, **options
    )
    settle(candidates.sparkSession, ledger, run)
    return came

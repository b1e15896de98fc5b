"""Replies kept one segment at a time: runs that die, repeated attempts, one winner."""

import os
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prefloom.sources import shared
from prefloom.streaming import ledger
from conftest import rows


def make(responder):
    return lambda: responder


def always(prompts, seeds):
    return ["排名：1 > 2"] * len(prompts)


def candidates(spark, n, start=0):
    data = [(start + i, f"text {i % max(1, n - 2)}", "", "", ["x", "y"]) for i in range(n)]
    return spark.createDataFrame(
        data, "pos bigint, instruction string, input string, ground_truth string, responses array<string>"
    )


def counting(log, fatal=None):
    """Notes every prompt in a file; a prompt that holds ``fatal`` ends the worker process."""

    def respond(prompts, seeds):
        if fatal and any(fatal in p for p in prompts):
            os._exit(1)
        with open(log, "a") as f:
            f.writelines(f"{s}\n" for s in seeds)
        return ["排名：2 > 1"] * len(prompts)

    return lambda: respond


def calls(log):
    return Path(log).read_text().split() if Path(log).exists() else []


def test_replies_outlive_a_run_that_dies(spark, tmp_path):
    folder, log = str(tmp_path / "ledger"), str(tmp_path / "log")
    df = candidates(spark, 60)
    options = dict(partitions=1, batch_size=2, flush_rows=4)
    with pytest.raises(Exception, match="crashed|exited"):
        ledger.rank_recorded(df, folder, 0, counting(log, fatal="text 31"), **options)
    before = calls(log)
    kept = ledger.read_replies(spark, folder).count()
    assert 0 < kept <= len(before) < kept + 4 and len(set(before)) == len(before)
    came = ledger.rank_recorded(df, folder, 0, counting(log), **options)
    assert came == 60 - kept
    # nothing was asked twice but what the lost segment held
    assert len(calls(log)) == len(before) + 60 - kept and len(set(calls(log))) == 60
    state = ledger.read_ledger(df, folder)
    assert state.count() == 60 and state.filter("rank_status = 'ok' and run = 0").count() == 60
    # a finished run is one table, and the next one has nothing to ask
    assert shared.names(f"{folder}/segments") == []
    assert ledger.rank_recorded(df, folder, 1, counting(log), **options) == 0


def test_a_repeated_attempt_asks_what_is_missing(tmp_path):
    folder, log = str(tmp_path / "part=0"), str(tmp_path / "log")
    batch = pa.RecordBatch.from_pydict({"key": list("abcdef"), "seed": list(range(6)), "prompt": [f"p{i}" for i in range(6)]})
    first = ledger.answered_by(iter([batch.slice(0, 3), batch.slice(3)]), folder, counting(log), 1, 2)
    assert next(first) == 2  # the attempt is lost after one segment
    assert list(ledger.answered_by(iter([batch.slice(4), batch.slice(0, 4)]), folder, counting(log), 2, 10)) == [4]
    assert len(calls(log)) == 6 and len(shared.names(folder)) == 2
    assert list(ledger.answered_by(iter([batch]), folder, counting(log), 2, 10)) == []


def test_failures_are_asked_again_in_the_same_run(tmp_path):
    folder = str(tmp_path / "part=0")
    batch = pa.RecordBatch.from_pydict({"key": ["a", "b"], "seed": [1, 2], "prompt": ["good", "bad"]})

    def picky(prompts, seeds):
        if "bad" in prompts:
            raise RuntimeError("refused")
        return prompts

    assert list(ledger.answered_by(iter([batch]), folder, make(picky), 2, 1)) == [2]
    assert list(ledger.answered_by(iter([batch]), folder, make(lambda p, s: p), 2, 1)) == [1]


def test_one_winner(spark):
    reply = [
        ("k", 1, "a", "success", "s2", 0), ("k", 1, "b", "success", "s1", 0), ("k", 1, None, "error: x", "s0", 0),
        ("k", 2, "old", "success", "s1", 0), ("k", 2, "new", "success", "s9", 1), ("k", 3, None, "error: y", "s1", 0),
    ]
    df = spark.createDataFrame(reply, "key string, seed bigint, reply string, status string, segment string, run bigint")
    assert rows(ledger.winners(df), "key", "seed", "run", "reply") == [("k", 1, 0, "b"), ("k", 2, 1, "new"), ("k", 3, 0, None)]


def test_rows_with_one_key_keep_their_own_replies(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = candidates(spark, 1).withColumn("pos", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(40)])))
    assert ledger.rank_recorded(df, folder, 0, make(always), flush_rows=5) == 40
    state = ledger.read_ledger(df, folder)
    assert state.select("key").distinct().count() == 1 and state.select("pos").distinct().count() == 40


def test_key_columns_are_bound(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = candidates(spark, 2).withColumn("status", F.lit("mine"))
    ledger.rank_recorded(df, folder, 0, make(always))
    with pytest.raises(ValueError, match="key_cols"):
        ledger.read_ledger(df, folder, ("instruction", "input"))
    assert ledger.read_ledger(df, folder).count() == 2


def test_no_candidates(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    df = candidates(spark, 1).filter("false")
    assert ledger.rank_recorded(df, folder, 0, make(always)) == 0
    assert ledger.read_ledger(df, folder).count() == 0


def test_a_half_written_segment_is_not_seen(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    ledger.rank_recorded(candidates(spark, 3), folder, 0, make(always))
    part = tmp_path / "ledger" / "segments" / "run=00000001" / "part=00000000"
    part.mkdir(parents=True)
    (part / "_half").write_bytes(b"PAR1")
    assert ledger.read_replies(spark, folder).count() == 3
    (part / "_half").unlink()


def test_a_task_holds_the_prompts_of_one_call(spark, tmp_path, monkeypatch):
    sizes = str(tmp_path / "sizes")
    plain = ledger.answered_by

    def watched(batches, *args):
        def seen():
            for batch in batches:
                with open(sizes, "a") as f:
                    f.write(f"{batch.num_rows}\n")
                yield batch

        return plain(seen(), *args)

    monkeypatch.setattr(ledger, "answered_by", watched)
    before = spark.conf.get(ledger.ARROW_ROWS)
    came = ledger.rank_recorded(candidates(spark, 50), str(tmp_path / "ledger"), 0, make(always), partitions=1, batch_size=8)
    assert came == 50 and spark.conf.get(ledger.ARROW_ROWS) == before
    assert max(map(int, Path(sizes).read_text().split())) == 8

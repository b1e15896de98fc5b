"""Rankings in levels: the same state as full history, opened bucket by bucket."""

import math

import pytest
from pyspark.sql import functions as F

from prefloom.operators.staging import CLEANUP
from prefloom.sources import shared
from prefloom.sources.records import path_bytes
from prefloom.streaming import store
from conftest import rows


def make(responder):
    return lambda: responder


def always(prompts, seeds):
    return ["排名：1 > 2"] * len(prompts)


def only_short(prompts, seeds):
    return ["排名：2 > 1" if "long" not in p else "?" for p in prompts]


def refuse(prompts, seeds):
    raise AssertionError("nothing may be asked")


def candidates(spark, *instructions, start=0):
    data = [(start + i, t, "", "", ["x", "y"]) for i, t in enumerate(instructions)]
    return spark.createDataFrame(
        data, "pos bigint, instruction string, input string, ground_truth string, responses array<string>"
    )


def state(spark, path):
    return rows(store.read_store(spark, path), "instruction", "pos", "batch", "sorted_indices")


def results(spark, batch, keys, ranked=True):
    data = [
        (batch * 1000 + i, f"t{k}", "", "", ["x"], "success", [0] if ranked else None, "", "", "ok", f"{k * 2654435761 % 2**32:08x}{k:024x}", batch)
        for i, k in enumerate(keys)
    ]
    return spark.createDataFrame(data, store.STORED)


def test_live_ranges():
    assert store.live_ranges(0) == [] and store.live_ranges(1) == [(0, 0)]
    assert store.live_ranges(6) == [(2, 0), (1, 4)] and store.live_ranges(7) == [(2, 0), (1, 4), (0, 6)]
    for n in range(70):
        covered = [b for level, start in store.live_ranges(n) for b in range(start, start + (1 << level))]
        assert covered == list(range(n))


def test_batches_resume(spark, tmp_path):
    path = str(tmp_path / "store")
    store.rank_stored(candidates(spark, "a", "long b", "a", None, "long b"), path, 0, make(only_short))
    assert state(spark, path) == [("a", 2, 0, [1, 0]), ("long b", 4, 0, None)]
    store.rank_stored(candidates(spark, "a", "long b", "c", start=10), path, 1, make(always))
    assert state(spark, path) == [("a", 2, 0, [1, 0]), ("c", 12, 1, [0, 1]), ("long b", 11, 1, [0, 1])]
    store.rank_stored(candidates(spark, "a", "c", "long b", start=20), path, 2, make(refuse))
    assert store.finished_batches(path) == 3 and len(state(spark, path)) == 3


@pytest.mark.parametrize("batch", [1, 2, 3])
def test_a_repeated_batch_replaces_itself(spark, tmp_path, batch):
    path = str(tmp_path / "store")
    for b in range(batch):
        store.rank_stored(candidates(spark, f"t{b}"), path, b, make(always))
    store.rank_stored(candidates(spark, "first try", "t0"), path, batch, make(only_short))
    store.rank_stored(candidates(spark, "second try", "t0"), path, batch, make(always))
    got = [r[0] for r in state(spark, path)]
    assert got == sorted(["second try"] + [f"t{b}" for b in range(batch)])


def test_a_batch_that_died_keeps_its_replies(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    df = candidates(spark, "a", "b", "c")

    def stop(*args, **kwargs):
        raise RuntimeError("died before the write")

    with monkeypatch.context() as m:
        m.setattr(store, "append", stop)
        with pytest.raises(RuntimeError):
            store.rank_stored(df, path, 0, make(always))
    store.rank_stored(df, path, 0, make(refuse))
    assert len(state(spark, path)) == 3


def test_gaps_and_other_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(ValueError, match="without gaps"):
        store.rank_stored(candidates(spark, "a"), path, 3, make(always))
    with pytest.raises(ValueError, match="key_cols"):
        store.rank_stored(candidates(spark, "a"), path, 0, make(always), key_cols=("instruction", "input"))


def test_history_read_grows_by_the_logarithm(spark, tmp_path):
    """n batches open O(n log n) rows, looked up and merged, not O(n * n)."""
    path, n, size = str(tmp_path / "store"), 24, 12
    looked_up = merged = whole = 0
    for b in range(n):
        keys = [b * 8 + i for i in range(size)]  # a third of the keys were in the batch before
        new = results(spark, b, keys)
        prefixes = [r[0] for r in new.select(store.prefix()).distinct().collect()]
        looked_up += store.history(spark, path, b, prefixes).count()
        whole += sum(size << level for level, _ in store.live_ranges(b))
        done = b + 1
        start = done - (done & -done)
        merged += sum(size << level for level, s in store.live_ranges(b) if s >= start)
        store.forget_replaced(path, b)
        store.append(new, path, b)
    bound = n * math.log2(n) * size
    assert merged <= bound and looked_up <= bound < whole
    assert looked_up < whole / 4
    found = store.read_store(spark, path)
    assert found.count() == found.select("key").distinct().count() == (n - 1) * 8 + size
    # ranges that were merged are gone, but for those the last batch may need again
    alive = sum(len(shared.names(f"{path}/{level}")) for level in shared.names(path))
    assert alive <= 2 * math.log2(n) + 2


def test_buckets_are_pruned(spark, tmp_path):
    path = str(tmp_path / "store")
    store.append(results(spark, 0, range(200)), path, 0)
    one = store.history(spark, path, 1, [0])
    assert "bucket" in one._jdf.queryExecution().executedPlan().toString() and one.count() < 40


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "store")
    for b in range(3):
        store.rank_stored(candidates(spark, "a").filter("false"), path, b, make(refuse))
    store.rank_stored(candidates(spark, "a"), path, 3, make(always))
    assert [r[0] for r in state(spark, path)] == ["a"]


def test_pack_keeps_nulls_and_empty_lists(spark):
    data = [("a", None, "", ["x", None]), (None, "b", None, []), ("c", "", "d", None)]
    df = spark.createDataFrame(data, "instruction string, input string, ground_truth string, responses array<string>")
    assert rows(store.unpack(store.pack(df)), *df.columns) == rows(df)


@pytest.mark.parametrize("slices", [1, 2, 8, 16])
def test_every_key_is_in_one_slice(spark, slices):
    keys = [None, "", "0", "0f", "7fff", "8", "9", "A", "f", "ffff", "z"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    found = [r[0] for n in range(slices) for r in df.filter(store._in_slice(n, slices)).collect()]
    assert len(found) == len(keys) and set(found) == set(keys)


def test_slices_by_size():
    assert [store._slices(n * store.SLICE_BYTES) for n in (0, 1, 2, 3, 4, 9, 16, 1000)] == [1, 1, 2, 4, 4, 16, 16, 16]


def merged(spark, path, monkeypatch, slice_bytes):
    """State after three batches with failures that come again and rows that come twice."""
    with monkeypatch.context() as m:
        m.setattr(store, "SLICE_BYTES", slice_bytes)
        store.append(results(spark, 0, range(40), ranked=False), path, 0, 1)
        again = results(spark, 1, range(20, 60))
        store.append(again.union(again), path, 1, 1)
        store.append(results(spark, 2, range(50, 70)), path, 2, 1)
    columns = ["key", "pos", "batch", "instruction", "input", "ground_truth", "responses", "sorted_indices"]
    return rows(store.read_store(spark, path, base_bits=1), *columns)


def test_slices_give_the_same_state(spark, tmp_path, monkeypatch):
    whole = merged(spark, str(tmp_path / "whole"), monkeypatch, 1 << 40)
    sliced = merged(spark, str(tmp_path / "sliced"), monkeypatch, 1)
    assert whole == sliced and len({r[0] for r in whole}) == 70 and len(whole) > 70


def test_a_merge_cut_off_is_no_success(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    monkeypatch.setattr(store, "SLICE_BYTES", 1)
    here = store._in_slice

    def third_slice_dies(number, slices):
        if number == 2:
            raise RuntimeError("died between slices")
        return here(number, slices)

    with monkeypatch.context() as m:
        m.setattr(store, "_in_slice", third_slice_dies)
        with pytest.raises(RuntimeError):
            store.append(results(spark, 0, range(40)), path, 0)
    assert shared.names(f"{path}/level=0/start=0000000000") and store.finished_batches(path) == 0
    store.append(results(spark, 0, range(30)), path, 0)
    assert store.finished_batches(path) == 1 and len(state(spark, path)) == 30


def test_ranges_without_packed_texts_are_read(spark, tmp_path):
    path = str(tmp_path / "store")
    old = results(spark, 0, range(9))
    old.withColumn("bucket", F.shiftright(store.prefix(), 12)).write.partitionBy("bucket").parquet(f"{path}/level=0/start=0000000000")
    assert rows(store.history(spark, path, 1)) == rows(old)
    store.append(results(spark, 1, range(5, 12)), path, 1)
    assert [r[0] for r in state(spark, path)] == sorted(f"t{k}" for k in range(12))
    assert rows(store.read_store(spark, path), "responses") == [(["x"],)] * 12


def test_a_batch_leaves_little_on_disk(spark, tmp_path, monkeypatch):
    """Scratch tables go with their batch, texts that repeat take little room, and of what is shuffled
    nothing stays until the driver collects its garbage."""
    monkeypatch.setattr(store, "scratch_folder", lambda spark, name: f"{tmp_path}/scratch/{name}-{len(made)}-{made.append(name)}")
    made, freed = [], []
    write = store.record_replies

    def recorded(asked, *args, **options):
        freed.append(asked.sparkSession.conf.get(CLEANUP))
        return write(asked, *args, **options)

    monkeypatch.setattr(store, "record_replies", recorded)
    texts = spark.range(300).select("id", *[F.sha2(F.concat_ws("-", "id", F.lit(i)), 512).alias(f"t{i}") for i in range(20)])
    text = F.concat(*[f"t{i}" for i in range(20)])
    df = texts.select(
        F.col("id").alias("pos"), text.alias("instruction"), F.lit("").alias("input"), F.lit("").alias("ground_truth"),
        F.array(text, F.concat(text, F.lit("!"))).alias("responses"),
    )
    path = str(tmp_path / "store")
    store.rank_stored(df, path, 0, make(always))
    assert freed == ["true"] and spark.conf.get(CLEANUP) == "false"
    assert {"arrived", "ranked"} <= set(made) and shared.names(f"{tmp_path}/scratch") == []
    assert store.read_store(spark, path).join(df, ["pos", "instruction", "input", "ground_truth", "responses"]).count() == 300
    # 2,560 characters a row, half a byte each, three times
    assert path_bytes(spark, f"{path}/level=0") < 1.5 * 300 * 2560 / 2

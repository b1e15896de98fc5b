"""Folders bound to their key columns, NULL groups, and counts of a flow that is run once."""

import pytest
from pyspark.sql import functions as F

from prefloom.operators.positions import first_rows, number_rows
from prefloom.operators.preference import clean_preferences, preference_pairs, stage_counts
from prefloom.operators.splits import first_n
from prefloom.plans.preference import store_pairs
from prefloom.registry.queries import _ranked
from prefloom.sources import shared
from prefloom.streaming import ranking
from conftest import rows


def test_a_result_folder_keeps_its_key_columns(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.createDataFrame(
        [(0, "a", "x", "", ["p", "q"]), (1, "a", "y", "", ["p", "q"])],
        "pos bigint, instruction string, input string, ground_truth string, responses array<string>",
    )
    both = ("instruction", "input")
    ranking.rank_run(df, path, 0, lambda: lambda p, s: ["排名：1 > 2"] * len(p), key_cols=both)
    assert ranking.read_results(spark, path, 0, both).count() == 2
    with pytest.raises(ValueError, match="key_cols"):
        ranking.read_results(spark, path, 0)
    with pytest.raises(ValueError, match="key_cols"):
        ranking.rank_run(df, path, 1, lambda: lambda p, s: p)


def test_binding_is_seen_by_others_only_when_made(tmp_path):
    path = str(tmp_path / "x")
    shared.bind(path, create=False, a=1)
    assert not shared.exists(path)
    shared.bind(path, a=[1])
    shared.bind(path, a=[1])
    assert shared.names(path) == []
    with pytest.raises(ValueError):
        shared.bind(path, create=False, a=[2])


def test_null_groups_stop_the_job(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "a")], "pos bigint, g string")
    for made in (number_rows(df, "pos", ["g"], "n"), first_rows(df, 1, "pos", ["g"], "n")):
        with pytest.raises(Exception, match="NULL in group column g"):
            made.collect()
    assert rows(number_rows(df.filter("g IS NOT NULL"), "pos", ["g"], "n")) == [(0, "a", 0), (2, "a", 1)]


@pytest.mark.parametrize("limit", [None, 7, 100_000])
def test_counts_of_the_written_flow(spark, sf_dir, tmp_path, limit):
    ranked = _ranked(spark, sf_dir)
    made = store_pairs(ranked, str(tmp_path / "pairs"), limit, keep=("pos",))
    capped = first_n(clean_preferences(ranked), limit)
    pairs = preference_pairs(capped, keep=("pos",))
    assert rows(made.counts) == rows(stage_counts(ranked, capped, pairs))
    assert rows(made.rows) == rows(pairs)


def test_counts_without_rows(spark, sf_dir, tmp_path):
    made = store_pairs(_ranked(spark, sf_dir).filter(F.col("pos") < 0), str(tmp_path / "pairs"), 5)
    assert [r["n"] for r in made.counts.orderBy("step").collect()] == [0, 0, 0, 0] and made.rows.count() == 0

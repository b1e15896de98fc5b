"""Rejects, cleaning, pairs, keys and counts."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from prefloom.operators import preference, skew
from prefloom.plans.preference import accept_candidates, training_pairs
from conftest import rows

RANKED = "pos bigint, instruction string, input string, responses array<string>, sorted_indices array<bigint>"


def ranked(spark):
    return spark.createDataFrame(
        [
            (0, " 问 ", "i", [" a ", "b", "c"], [2, 0, 1]),
            (1, "q", "", ["a", "b"], None),
            (2, "q", "", ["a", "a"], [0, 1]),
            (3, "q", "", ["a"], [0]),
            (4, "q", "", None, [0, 1]),
            (5, "q", "", ["a", "b"], [0]),
            (6, "q", "", ["a", "b"], [0, 5]),
            (7, "q", "", ["a", "b"], [-1, 1]),
            (8, "q", "", ["a", " a"], [1, 0]),
            (9, None, "", ["a", "b"], [1, 1]),
            (10, "q", "", [], []),
        ],
        RANKED,
    )


def test_first_reason_counts(spark):
    reasons = ranked(spark).select("pos", preference.clean_reason().alias("r")).filter("r IS NOT NULL")
    assert rows(reasons) == [
        (1, "no_ranking"), (2, "duplicate_responses"), (3, "too_few_responses"), (4, "no_responses"),
        (10, "too_few_responses"),
    ]
    assert rows(preference.reject_reasons(ranked(spark))) == [
        ("duplicate_responses", 1), ("no_ranking", 1), ("no_responses", 1), ("too_few_responses", 2),
    ]


def test_strip_first_finds_more_duplicates(spark):
    kept = preference.clean_preferences(ranked(spark), strip_first=True)
    assert [r[0] for r in rows(kept, "pos")] == [0, 5, 6, 7, 9]


def test_pairs(spark):
    cleaned = preference.clean_preferences(ranked(spark))
    pairs = preference.preference_pairs(cleaned, keep=("pos",))
    head, tail = "<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n"
    assert rows(pairs) == [
        (0, f"{head}问{tail}", "c", "b"), (8, f"{head}q{tail}", "a", "a"), (9, f"{head}{tail}", "b", "b"),
    ]
    with_input = preference.preference_pairs(cleaned, include_input=True, keep=("pos",))
    assert rows(with_input, "pos", "prompt")[0] == (0, f"{head}问\ni{tail}")


def test_capped_pairs_and_counts(spark):
    pairs = training_pairs(ranked(spark), max_samples=1, keep=("pos",))
    assert [r[0] for r in rows(pairs.rows, "pos")] == [0]
    every = training_pairs(ranked(spark))
    assert every.rows.count() == 3
    assert every.counts.get == {"raw": 11, "cleaned": 6}


def test_stage_counts_of_nothing(spark):
    none = ranked(spark).filter("false")
    assert [r[2] for r in rows(preference.stage_counts(none, none, none))] == [0, 0, 0, 0]


def test_observation_needs_no_extra_pass(spark):
    seen = Observation()
    preference.observe_cleaning(ranked(spark), seen).select("pos").collect()
    assert seen.get == {"raw": 11, "cleaned": 6}


def test_candidate_records(spark):
    lines = [
        '{"instruction":"a","responses":["x","y"],"input":"i"}', '{"instruction":"a"}', '{"responses":["x","y"]}',
        '{"instruction":"a","responses":"text"}', '{"instruction":"a","responses":["x"]}',
        '{"instruction":null,"responses":["x","y"]}', '{"instruction":"a","responses":null}',
        '{"instruction":"a","responses":[1,null]}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "pos bigint, line string")
    names = ("instruction", "input", "ground_truth", "responses")
    records = df.select(
        "pos", *[F.try_variant_get(F.parse_json("line"), f"$.{n}", "variant").alias(n) for n in names]
    )
    accepted, rejects = accept_candidates(records)
    assert rows(rejects) == [
        (1, "missing_field"), (2, "missing_field"), (3, "invalid_responses"), (4, "invalid_responses"),
        (5, "null_instruction"), (6, "invalid_responses"),
    ]
    assert rows(accepted, "pos", "instruction", "input", "responses") == [
        (0, "a", "i", ["x", "y"]), (7, "a", None, ["1", None]),
    ]


def test_rank_replies(spark):
    df = spark.createDataFrame(
        [(0, "排名：2 > 1", ["a", "b"]), (1, "2 > 1", ["a", "b"]), (2, None, ["a", "b"]), (3, "排名：2 > 3", ["a", "b"])],
        "pos bigint, api_response string, responses array<string>",
    )
    parsed = preference.parse_rankings(df)
    assert rows(parsed, "pos", "sorted_indices", "api_response", "raw_reply", "rank_status") == [
        (0, [1, 0], "排名：2 > 1", "排名：2 > 1", "ok"),
        (1, None, "Unknown error", "2 > 1", "no_prefix"),
        (2, None, "Unknown error", None, "no_reply"),
        (3, None, "Unknown error", "排名：2 > 3", "bad_ranking"),
    ]


def hot_rows(spark, n=4000):
    """A third of the rows share one key."""
    return spark.range(n).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("key"),
    )


def test_anti_join_with_hot_keys(spark):
    left = hot_rows(spark)
    for done in (["hot", "k1", "k5"], ["k2"], []):
        right = spark.createDataFrame([(k,) for k in done * 2], "key string")
        ours = skew.anti_join(left, right, "key", "pos", task_rows=100)
        assert rows(ours) == [r for r in rows(left) if r[1] not in done]


def test_hot_keys_are_few(spark):
    assert skew.hot_keys(hot_rows(spark), "key", 100).count() == 1
    assert skew.hot_keys(hot_rows(spark), "key").count() == 0


RESULT = "pos bigint, instruction string, sorted_indices array<int>"


def test_upsert(spark):
    earlier = spark.createDataFrame([(0, "a", [0]), (1, "b", None), (2, "c", [1]), (3, "c", [2])], RESULT)
    new = spark.createDataFrame([(4, "a", [3]), (5, "a", None), (6, "d", None)], RESULT)
    plain = preference.upsert_results(earlier, new)
    assert rows(plain, "instruction", "pos") == [("a", 5), ("c", 3), ("d", 6)]
    kept = preference.upsert_results(earlier, new, prefer_success=True)
    assert rows(kept, "instruction", "pos") == [("a", 4), ("c", 3), ("d", 6)]


def test_keys_of_several_columns(spark):
    rows_ = spark.createDataFrame([(0, "a", "x", [0]), (1, "a", "y", [0])], "pos bigint, instruction string, input string, sorted_indices array<int>")
    done = rows_.filter("pos = 0")
    assert rows(preference.pending_rows(rows_, done), "pos") == []
    assert rows(preference.pending_rows(rows_, done, ("instruction", "input")), "pos") == [(1,)]

"""Token tables and batches."""

import pytest

from prefloom.operators import chat, training
from conftest import rows


def make(tokenizer):
    return lambda: tokenizer


def code_points(texts):
    return [[ord(c) for c in text] for text in texts]


def texts(spark):
    return spark.createDataFrame([(3, "ab"), (10, "汉"), (11, ""), (20, None), (70000, "abc")], "pos bigint, text string")


def test_tokens(spark):
    assert rows(training.token_rows(texts(spark), "text", make(code_points))) == [
        (3, [97, 98], [97, 98]), (10, [27721], [27721]), (11, [], []), (70000, [97, 98, 99], [97, 98, 99])
    ]
    cut = training.token_rows(texts(spark), "text", make(code_points), max_tokens=2)
    assert rows(cut, "input_ids")[-1] == ([27721],) and max(len(r[0]) for r in rows(cut, "input_ids")) == 2


def test_batches(spark):
    tokens = training.token_rows(texts(spark), "text", make(code_points))
    assert rows(training.padded_batches(tokens, 3, 0)) == [
        (3, 0, 2, [97, 98], [97, 98]), (10, 0, 2, [27721, 0], [27721, -100]), (11, 0, 2, [0, 0], [-100, -100]),
        (70000, 1, 3, [97, 98, 99], [97, 98, 99]),
    ]


@pytest.mark.parametrize("n, batch, accumulation, steps", [(5000, 1, 16, 313), (0, 1, 16, 0), (33, 4, 2, 5)])
def test_steps(spark, n, batch, accumulation, steps):
    assert training.step_plan(spark.range(n), batch, accumulation).first()["steps"] == steps


def test_empty_examples_are_dropped(spark):
    df = spark.createDataFrame(
        [(0, "a", "i", "o"), (1, "", "i", "o"), (2, "a", "i", ""), (3, None, "i", "o"), (4, " ", " ", " "), (5, "a", "", None)],
        "pos bigint, instruction string, input string, output string",
    )
    kept = chat.supervised_messages(df, keep=("pos",))
    assert [(r["pos"], r["messages"][0]["content"]) for r in kept.orderBy("pos").collect()] == [(0, "a"), (4, " ")]
    with_input = chat.supervised_messages(df, include_input=True, keep=("pos",))
    assert with_input.orderBy("pos").first()["messages"][0]["content"] == "a\ni"

"""The derived instruction rows against a plain loop, over block edges."""

import random

import pytest

from prefloom.registry import inputs
from conftest import rows


@pytest.mark.parametrize("bits", [1, 2, 5, 10])
def test_neighbour_turns(spark, monkeypatch, bits):
    monkeypatch.setattr(inputs, "TURN_BITS", bits)
    rng = random.Random(bits)
    turns = {(c, t) for c in range(5) for t in range(3000 if c == 0 else rng.randint(1, 30)) if rng.random() < 0.95}
    data = {(c, t): (rng.choice(["user", "assistant"]), f"{c}/{t}") for c, t in turns}
    df = spark.createDataFrame(
        [(c, t, *v) for (c, t), v in data.items()], "conv_id bigint, turn bigint, role string, text string"
    )
    text = lambda c, t: data.get((c, t), ("", ""))[1]
    expected = sorted(
        (c * inputs.TURNS + t, c * 3 + t, v[1], text(c, t - 1), text(c, t + 1))
        for (c, t), v in data.items() if v[0] == "user"
    )
    assert rows(inputs.user_turns(df)) == expected

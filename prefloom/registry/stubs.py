"""Pure-function responders and tokenizer that stand in for a model."""

from __future__ import annotations

import re
from collections.abc import Sequence

# Fixed value: a prompt of a length divisible by this fails, to exercise error rows.
FAILS_AT = 7


def last_line(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    """The prompt's last line and length; raises for some prompts."""
    if any(len(p) % FAILS_AT == 0 for p in prompts):
        raise RuntimeError("refused")
    return [f"  {p.rsplit('\n', 1)[-1]} {len(p)}\n" for p in prompts]


def sampler(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    """The prompt's length and the seed modulo 4: four seeds in a row differ."""
    return [f" {len(p)}-{s % 4} " for p, s in zip(prompts, seeds)]


def judge(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    """A score from the prompt's length; raises for some prompts."""
    if any(len(p) % FAILS_AT == 0 for p in prompts):
        raise RuntimeError("refused")
    return [f"好的。<score>{len(p) % 12}.5</score>" for p in prompts]


def chooser(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    return [f"答案是{'ABCDE'[len(p) % 5]}" for p in prompts]


def first_ranker(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    """Ranks two prompts of three."""
    return ["不知道" if len(p) % 3 == 0 else "排名：2 > 1 > 4 > 3" for p in prompts]


def second_ranker(prompts: Sequence[str], seeds: Sequence[int]) -> list[str]:
    return ["排名：4 > 3 > 2 > 1"] * len(prompts)


def code_points(texts: Sequence[str]) -> list[list[int]]:
    return [[ord(c) for c in t] for t in texts]


def words(texts: Sequence[str]) -> list[list[int]]:
    """Lengths of the words: a short token list of the whole text."""
    return [[len(w) for w in re.split(" ", t)] for t in texts]

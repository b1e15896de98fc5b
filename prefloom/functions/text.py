"""Python text semantics and reply parsing as column expressions.

Everything here stays in the JVM. Java's regular expressions differ from
Python's in what counts as white space, a digit or a word, so the classes are
written out instead of using ``\\s``, ``\\d`` and ``\\b``.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python's str.strip() removes.
PY_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Reply format of the judge and the ranker.
RANK_PREFIX = "排名："
DEFAULT_SCORE = 5.0
LOWEST, HIGHEST = 1.0, 10.0

_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in PY_SPACES) + "]"
_WORD = r"[\p{L}\p{N}_]"
_NUMBER = r"\p{Nd}+(?:\.\p{Nd}+)?"
_TAGGED = f"<score>{_SPACE}*({_NUMBER}){_SPACE}*</score>"
_LONE = f"(?<!{_WORD})({_NUMBER})(?!{_WORD})"

# Decimal digits of every script beyond ASCII and the ASCII digit each stands for.
_DIGITS = [
    chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
]
_OTHER_DIGITS = "".join(_DIGITS)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def py_strip(text: Column) -> Column:
    """``str.strip()``: ``trim`` alone would remove U+0020 only."""
    return F.btrim(text, F.lit(PY_SPACES))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, _OTHER_DIGITS, _ASCII_DIGITS)


def py_round(x: Column, digits: int) -> Column:
    """``round(x, digits)`` as Python does it: on the exact binary value, ties to even.

    ``F.round`` works on the shortest decimal form (2.675 becomes 2.68, Python
    gives 2.67). The distance to the midpoint is computed without rounding error
    by splitting x into two parts that each multiply exactly.
    """
    scale = float(10**digits)
    high = x.cast("float").cast("double")
    floor = F.floor(x * scale).cast("double")
    over = (high * scale - (floor + 0.5)) + (x - high) * scale
    up = (over > 0) | ((over == 0) & (floor % 2 != 0))
    return F.when(up, (floor + 1) / scale).when(x.isNotNull(), floor / scale)


def choice_letter(text: Column) -> Column:
    """The first A, B, C or D anywhere, else the empty string."""
    return F.regexp_extract(text, "[ABCD]", 0)


def _to_double(text: Column) -> Column:
    return ascii_digits(text).try_cast("double")


def score_tag(reply: Column) -> Column:
    """Number in the first score tag, the empty string without one."""
    return F.regexp_extract(reply, _TAGGED, 1)


def judge_score(reply: Column, tag: Column | None = None) -> Column:
    """Score in a judge's reply: the first score tag clamped to 1..10, else the
    first free-standing number within 1..10, else 5. NULL for no reply.

    ``tag`` is a column that already holds ``score_tag``, which is used twice.
    """
    tagged = score_tag(reply) if tag is None else tag
    # greatest / least skip NULLs, so the clamp only runs where a tag was found
    clamped = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), _to_double(tagged)))
    numbers = F.transform(F.regexp_extract_all(reply, F.lit(_LONE), 1), _to_double)
    lone = F.get(F.filter(numbers, lambda x: x.between(LOWEST, HIGHEST)), F.lit(0))
    return F.when(tagged != "", clamped).when(
        reply.isNotNull(), F.coalesce(lone, F.lit(DEFAULT_SCORE))
    )


def ranking_numbers(reply: Column) -> Column:
    """0-based numbers between the first and second rank prefix, NULL without a prefix.

    The reply occurs once in the expression: a filter on the result is pushed
    below its projection, where every occurrence would be computed again.
    """
    part = F.get(F.split(reply, RANK_PREFIX), F.lit(1))
    digits = F.regexp_extract_all(part, F.lit(r"\p{Nd}+"), 0)
    # more digits than a BIGINT holds can never be an index: -1 is out of range
    return F.transform(
        digits, lambda d: F.coalesce(ascii_digits(d).try_cast("bigint") - 1, F.lit(-1))
    )


def valid_ranking(numbers: Column, n: Column, strict_permutation: bool = False) -> Column:
    """``numbers`` where they are n indices into n responses, else NULL.

    Repeats pass unless ``strict_permutation`` is set.
    """

    def ok(found: Column) -> Column:
        full = (F.size(found) == n) & F.forall(found, lambda i: (i >= 0) & (i < n))
        return full & (F.size(F.array_distinct(found)) == n) if strict_permutation else full

    return F.get(F.filter(F.array(numbers), ok), F.lit(0))

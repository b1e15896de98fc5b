"""Where and why a text is no JSON, as a column expression.

The text is cut into small tokens and folded over them with the state of a JSON reader: what
may come next, the open brackets, the open string. Messages and places are those of
Python's reader. A fold may begin in the middle of a text, at a known state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character of a text is in exactly one token
_TOKEN = (
    r'(?s)\\u[0-9a-fA-F]{4}|\\.|\\|"|[{}\[\]:,]|[ \t\n\r]+|[\x00-\x1f]|[^"\\{}\[\]:, \t\n\r\x00-\x1f]+'
)
_SCALAR = r"^(?:NaN|-?Infinity|true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)"
_ESCAPE = r'^\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})$'

# What may come next. VALUE after a colon or at the start, FIRST after "[", ITEM after a comma in an
# array, MEMBER after "{", KEY after a comma in an object, COLON after a key, AFTER behind a value.
VALUE, FIRST, ITEM, MEMBER, KEY, COLON, AFTER = range(7)

# The messages of Python's reader.
_EXPECTED = {
    VALUE: "Expecting value", FIRST: "Expecting value", ITEM: "Expecting value",
    MEMBER: "Expecting property name enclosed in double quotes",
    KEY: "Expecting property name enclosed in double quotes",
    COLON: "Expecting ':' delimiter",
}
_MORE, _EXTRA = "Expecting ',' delimiter", "Extra data"
_UNTERMINATED = "Unterminated string starting at"
_CONTROL, _BAD_ESCAPE, _BAD_UNICODE = "Invalid control character at", "Invalid \\escape", "Invalid \\uXXXX escape"
_TRAILING = {KEY: "Illegal trailing comma before end of object", ITEM: "Illegal trailing comma before end of array"}


def _state(at, stack, expected, quote, comma, error, message) -> Column:
    return F.struct(
        at.cast("int").alias("at"), stack.alias("stack"), expected.cast("int").alias("expected"),
        quote.cast("int").alias("quote"), comma.cast("int").alias("comma"), error.cast("int").alias("error"),
        message.cast("string").alias("message"),
    )


def _missing(expected: Column, stack: Column) -> Column:
    """What is said when something else comes than ``expected``."""
    told = F.when(stack == "", _EXTRA).otherwise(_MORE)
    for code, message in _EXPECTED.items():
        told = F.when(expected == code, message).otherwise(told)
    return told


def _step(s: Column, token: Column) -> Column:
    at, stack, expected, quote, comma = (s[c] for c in ("at", "stack", "expected", "quote", "comma"))
    first, size = F.substring(token, 1, 1), F.length(token)
    none, nothing = F.lit(-1), F.lit(None)

    def go(expected=expected, stack=stack, quote=quote, comma=comma) -> Column:
        return _state(at + size, stack, expected, quote, comma, none, nothing)

    def fail(place: Column, message) -> Column:
        message = F.lit(message) if isinstance(message, str) else message
        return _state(at + size, stack, expected, quote, comma, place, message)

    # inside a string
    control = F.regexp_instr(token, F.lit(r"[\x00-\x1f]"))
    ended = F.when(expected.isin(MEMBER, KEY), COLON).otherwise(AFTER)
    in_string = (
        F.when(first == '"', go(ended, quote=none))
        .when((first == "\\") & (size > 1) & ~token.rlike(_ESCAPE), F.when(
            F.substring(token, 2, 1) == "u", fail(at + 1, _BAD_UNICODE)).otherwise(fail(at, _BAD_ESCAPE)))
        .when(control > 0, fail(at + control - 1, _CONTROL))
        .otherwise(go())
    )
    # outside
    value = expected.isin(VALUE, FIRST, ITEM)
    top, rest = F.right(stack, F.lit(1)), F.substring(stack, F.lit(1), F.length(stack) - 1)
    wrong = fail(at, _missing(expected, stack))
    scalar = F.length(F.regexp_extract(token, _SCALAR, 0))

    def closing(bracket: str, empty: int, after_comma: int) -> Column:
        return (
            F.when((expected == empty) | ((expected == AFTER) & (top == bracket)), go(F.lit(AFTER), rest))
            .when(expected == after_comma, fail(comma, _TRAILING[after_comma])).otherwise(wrong)
        )

    outside = (
        F.when(first.isin(" ", "\t", "\n", "\r"), go())
        .when(first == '"', F.when(value | expected.isin(MEMBER, KEY), go(quote=at)).otherwise(wrong))
        .when(first == "{", F.when(value, go(F.lit(MEMBER), F.concat(stack, F.lit("{")))).otherwise(wrong))
        .when(first == "[", F.when(value, go(F.lit(FIRST), F.concat(stack, F.lit("[")))).otherwise(wrong))
        .when(first == "}", closing("{", MEMBER, KEY))
        .when(first == "]", closing("[", FIRST, ITEM))
        .when(first == ",", F.when(
            (expected == AFTER) & (stack != ""), go(F.when(top == "{", KEY).otherwise(ITEM), comma=at)).otherwise(wrong))
        .when(first == ":", F.when(expected == COLON, go(F.lit(VALUE))).otherwise(wrong))
        .when(~value | (scalar == 0), wrong)
        .when(scalar < size, fail(at + scalar, F.when(stack == "", _EXTRA).otherwise(_MORE)))
        .otherwise(go(F.lit(AFTER)))
    )
    return F.when(s["error"] >= 0, s).when(quote >= 0, in_string).otherwise(outside)


def json_error(
    text: Column, expected: Column | None = None, stack: Column | None = None, more: Column | None = None
) -> Column:
    """(at, message) of the first error in ``text``, NULL where there is none.

    ``at`` counts characters from 0. The reader starts where a whole text starts, or in the
    state ``expected`` with the open brackets ``stack``; with ``more`` the text goes on, so
    that its end is no error.
    """
    start = _state(
        F.lit(0), F.lit("") if stack is None else stack, F.lit(VALUE) if expected is None else expected,
        F.lit(-1), F.lit(-1), F.lit(-1), F.lit(None),
    )
    more = F.lit(False) if more is None else more

    def finish(s: Column) -> Column:
        complete = (s["expected"] == AFTER) & (s["stack"] == "")
        def place(at, message):
            return F.struct(at.alias("at"), message.alias("message"))
        return (
            F.when(s["error"] >= 0, place(s["error"], s["message"]))
            .when(more, None)
            .when(s["quote"] >= 0, place(s["quote"], F.lit(_UNTERMINATED)))
            .when(~complete, place(s["at"], _missing(s["expected"], s["stack"])))
        )

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, _step, finish)

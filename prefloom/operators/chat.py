"""Supervised chat examples and response rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import compose_prompt, message
from prefloom.functions.text import py_strip


def supervised_messages(df: DataFrame, include_input: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One user / assistant pair per instruction row with both texts present.

    The row's ``input`` is left out unless ``include_input`` is set.
    """
    user = F.col("instruction")
    if include_input:
        user = compose_prompt(user, F.col("input"))
    return df.filter((user != "") & (F.col("output") != "")).select(
        *keep, F.array(message("user", user), message("assistant", F.col("output"))).alias("messages")
    )


def response_rows(df: DataFrame, text: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    """Instruction, input, reference answer and the stripped generated text."""
    return df.select(
        *keep, "instruction", "input",
        F.coalesce("output", F.lit("")).alias("ground_truth"),
        py_strip(F.col(text)).alias("response"),
    )


def candidate_rows(df: DataFrame, texts: str = "responses", keep: tuple[str, ...] = ()) -> DataFrame:
    """Like ``response_rows`` for several generated texts per row."""
    return df.select(
        *keep, "instruction", "input",
        F.coalesce("output", F.lit("")).alias("ground_truth"),
        F.transform(texts, py_strip).alias("responses"),
    )


def zip_outputs(rows: DataFrame, outputs: DataFrame, pos: str = "pos") -> DataFrame:
    """The i-th generated output with the i-th row. ``pos`` is unique on both sides."""
    return rows.join(outputs, pos)

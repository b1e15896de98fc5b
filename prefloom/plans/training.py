"""From instruction rows to padded token batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.functions.prompts import CHATML, ChatTemplate, render_chat
from prefloom.operators.chat import supervised_messages
from prefloom.operators.training import Tokenizer, padded_batches, token_rows
from prefloom.session import scratch_folder
from prefloom.sources.records import write_once


def supervised_tokens(
    rows: DataFrame,
    tokenizer_factory: Callable[[], Tokenizer],
    template: ChatTemplate = CHATML,
    include_input: bool = False,
) -> DataFrame:
    """Token rows of the chat examples, rendered without a mark for a reply."""
    examples = supervised_messages(rows, include_input, keep=("pos",))
    rendered = examples.select("pos", render_chat(F.col("messages"), template, generate=False).alias("text"))
    return token_rows(rendered, "text", tokenizer_factory)


def supervised_batches(
    rows: DataFrame,
    tokenizer_factory: Callable[[], Tokenizer],
    batch_size: int,
    pad_id: int,
    out: str | None = None,
    **options,
) -> DataFrame:
    """Padded batches; the tokens are written once, to ``out`` or the shared scratch folder."""
    spark = rows.sparkSession
    out = out or scratch_folder(spark, "tokens")
    write_once(supervised_tokens(rows, tokenizer_factory, **options).drop("labels"), out)
    return padded_batches(spark.read.parquet(out), batch_size, pad_id)

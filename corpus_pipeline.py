"""Corpus pipeline: five stages over ``documents``, each written before the next.

A stage takes (spark, docs, sf_dir) and works on everything its predecessor kept.
All but the last return the columns of documents; the last adds the ids of the pieces.

1. quality: documents that the classifier rejects go. It learns from the documents
   at hand and the labels whose fold is not 0.
2. lines: lines that come again, exactly or nearly, go from all documents but the first that
   has them. A document that loses all its lines goes.
3. near: one document of each group of near copies stays, the one with the smallest doc_id.
4. mix: sources come in shares of their target weights, whole documents, repeated
   or left out as the mix takes them, in training order.
5. pieces: the ids of the pieces of every text.

Defined results for nulls, empty texts, repeated rows and empty tables are those of
the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefloom.llm import lines, mixing, near, pieces, quality
from prefloom.llm.tables import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # n_chars follows the text
    return lines.remove_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.load())


STAGES = [
    ("quality", keep_good),
    ("lines", remove_lines),
    ("near", keep_first),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]

# the first stage fits a model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

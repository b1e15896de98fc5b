"""The queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefloom.llm import (
    bytepairs, divergence, embeddings, fingerprints, hmm, language, lines, middle, mixing, near, pieces, quality, repeats,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op2_join_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op3_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"), spark)


def op4_classify_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_remove_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_fingerprints(table(spark, sf_dir, "documents"))


def op8_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.middle_report(table(spark, sf_dir, "documents"))


def op12_audit_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_encode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytepairs.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_remove_repeats": op1_remove_repeats,
    "op2_join_near": op2_join_near,
    "op3_encode_pieces": op3_encode_pieces,
    "op4_classify_quality": op4_classify_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_remove_lines": op6_remove_lines,
    "op7_fingerprints": op7_fingerprints,
    "op8_near_embeddings": op8_near_embeddings,
    "op9_identify_language": op9_identify_language,
    "op10_score_texts": op10_score_texts,
    "op11_fill_middle": op11_fill_middle,
    "op12_audit_sources": op12_audit_sources,
    "op13_encode_bytes": op13_encode_bytes,
}

"""Queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from salesmart.llm import (ann, chat, decontaminate, langid, lexical, line_dedup, merkle, mixing, near_dedup, secrets,
                           suffix_dedup, toxicity, window_dedup)
from salesmart.llm.common import table


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.calibrate(table(spark, sf_dir, "documents"), hold_budget=True)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeats(table(spark, sf_dir, "documents")).drop("h")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), merkle.tampered()).drop("copied")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mixture, op2_secrets, op3_line_repeats, op4_chat, op5_benchmark_leaks, op6_repeated_strings,
                            op7_near_duplicates, op8_toxicity, op9_language, op10_nearest_vectors,
                            op11_manifest, op12_ranked_search, op13_repeated_passages, pipeline)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {"op4_chat": chat.RENDER_SQL, "op5_benchmark_leaks": decontaminate.LEAKS_SQL,
                          "op6_repeated_strings": suffix_dedup.REPEATS_SQL, "op7_near_duplicates": near_dedup.COMPONENTS_SQL,
                          "op11_manifest": merkle.AUDIT_SQL, "op12_ranked_search": lexical.SEARCH_SQL,
                          "op13_repeated_passages": window_dedup.WINDOWS_SQL}

"""Queries over the corpus tables: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from brickfolio.llm import (
    chat, decontaminate, fm_dedup, importance, language, lattice, line_dedup, quality_rules, secrets, simhash, site_quality, warc, zone_clusters,
)
from brickfolio.llm.tables import read

Build = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_text")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.report(read(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(read(spark, sf_dir, "conversations"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pages have no time of capture: one a second, in order of their ids
    captured = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + 1_700_000_000)
    return warc.report(read(spark, sf_dir, "pages"), captured)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.cluster(read(spark, sf_dir, "embeddings"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Build] = {f.__name__: f for f in (
    op1_substring_dedup,
    op2_quality_classifier,
    op3_simhash_near_dedup,
    op4_chat_formatting,
    op5_secret_scan,
    op6_benchmark_decontamination,
    op7_language_id,
    op8_quality_rules,
    op9_line_dedup,
    op10_sentencepiece,
    op11_warc,
    op12_centroid_clustering,
    op13_importance_resampling,
)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES: dict[str, str] = {
    "op4_chat_formatting": chat.REPORT_SQL, "op6_benchmark_decontamination": decontaminate.REPORT_SQL, "op11_warc": warc.REPORT_SQL,
    "op12_centroid_clustering": zone_clusters.CLUSTER_SQL}

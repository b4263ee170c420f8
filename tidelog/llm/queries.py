"""The registered queries of this package, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidelog.llm import (
    decontamination, exact_dedup, jaccard_join, license_scan, merkle, packing, periodic_runs, pii,
    quality, sharding, substring_dedup, toxicity, url_filter)
from tidelog.llm.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(name: str, oracle: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return run(spark, folder)

        QUERIES[name] = shipped
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return add


@register("op1_substring_dedup", substring_dedup.ORACLE)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


@register("op2_url_filter", url_filter.ORACLE)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"))


@register("op3_exact_dedup", exact_dedup.ORACLE)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@register("op4_sharding", sharding.oracle(sharding.shard_names(sharding.SHARDS), sharding.SLOTS))
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(
        table(spark, folder, "documents"), sharding.shard_names(sharding.SHARDS), sharding.SLOTS)


@register("op5_pii")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


@register("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op7_decontamination", decontamination.ORACLE)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.decontaminate(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register("op8_license_scan", license_scan.ORACLE)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


@register("op9_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_jaccard_join", jaccard_join.ORACLE)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join_near(table(spark, folder, "documents"))


@register("op11_quality_rules", quality.ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge_quality(
        table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op12_periodic_runs", periodic_runs.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.collapse_runs(table(spark, folder, "documents"), planted=True)


@register("op13_merkle_manifest", merkle.ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.prove_rows(table(spark, folder, "documents"))


register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

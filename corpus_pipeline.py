"""A corpus from raw documents to training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from tidelog.llm.ship import ship
from tidelog.sources.shared import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: Each stage's result is written and read again as the next one's documents; all but the last
#: return the columns of their documents.
STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies),
          ("n-gram Jaccard join", drop_near_copies), ("benchmark decontamination", drop_benchmark),
          ("packing", pack)]
#: The toxicity model cannot be written in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Outgoing messages: topic, key and JSON value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entry_value(columns: list[str]) -> Column:
    """An entry as JSON text, null fields kept so every message has one shape."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def publish_changes(
    entries: DataFrame, topic: str, columns: list[str] | None = None,
    topic_col: str | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One (topic, null key, value) row per entry, as a Kafka sink takes them.

    A topic column overrides the topic per entry. A null key lets the sink spread
    entries over partitions, so a hot table fills no single one.
    """
    chosen = columns or [c for c in entries.columns if c != topic_col]
    target = F.coalesce(topic_col, F.lit(topic)) if topic_col else F.lit(topic)
    return entries.select(
        *keep, target.alias("topic"), F.lit(None).cast("string").alias("key"),
        entry_value(chosen).alias("value"),
    )


def partition_by_suffix(df: DataFrame, key_col: str, n: int) -> DataFrame:
    """Partition number from the integer after the key's last dot, modulo n (sign kept).

    Zero when there is no dot after the first character; null when the suffix is
    not an integer.
    """
    suffix = F.regexp_extract(key_col, r"(?s)\A.+\.([^.]*)\z", 1)
    has_dot = F.col(key_col).rlike(r"(?s)\A.+\.[^.]*\z")
    number = F.when(suffix.rlike(r"\A[+-]?\d+\z"), suffix).try_cast("int")
    return df.withColumn("partition_id", F.when(has_dot, number % n).otherwise(F.lit(0)))

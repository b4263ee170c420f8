"""Table filters on events and entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import text as X
from tidelog.operators.ordered import DEFAULT_WIDTH, positions

FILTER_LOG_EVERY = 500


def full_name() -> Column:
    return F.concat(F.coalesce("db", F.lit("")), F.lit("."), F.coalesce("tbl", F.lit("")))


def match_tables(df: DataFrame, patterns: str | None = None) -> DataFrame:
    """Rows whose ``db.tbl`` fully matches one of the comma-separated patterns."""
    return df.filter(X.matches_any(full_name(), patterns))


def match_tables_ci(df: DataFrame, patterns: str | None) -> DataFrame:
    return df.filter(X.matches_any_ci(full_name(), patterns))


def _listed(df: DataFrame, allow: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose name is listed. A Python list is a constant predicate; a table is
    semi-joined, and Spark broadcasts it only when its measured size allows."""
    if isinstance(allow, DataFrame):
        names = allow.select(F.col("dbtb").alias("_name"))
        return df.withColumn("_name", full_name()).join(names, "_name", "left_semi").drop("_name")
    return df.filter(full_name().isin(list(allow)))


def allow_tables(rows: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Allowlist on rows events; an empty list passes everything."""
    return _listed(rows, allow) if len(allow) else rows


def allow_entries_strict(entries: DataFrame, allow: Sequence[str] | DataFrame) -> DataFrame:
    """Allowlist on entries; an empty list drops everything, and markers always drop."""
    return _listed(entries, allow)


def allow_entries_open(entries: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Allowlist on entries; an empty list passes everything, markers included."""
    return _listed(entries, allow) if len(allow) else entries


def filtered_runs(
    entries: DataFrame, allow: Sequence[str], n: int = FILTER_LOG_EVERY,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """A record whenever a run of consecutive filtered entries reaches a multiple of n."""
    kept = full_name().isin(list(allow))
    marked = entries.withColumn("_kept", kept).withColumn("last_name", full_name())
    counted = positions(marked, ["server_id"], "seq", F.col("_kept"), width=width)
    run = F.col("since_mark") + 1
    return counted.filter(~F.col("_kept") & (run % n == 0)).select(
        "server_id", "seq", "last_name", run.alias("run_length")
    )

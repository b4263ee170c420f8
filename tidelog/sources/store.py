"""The change store: entries and cells kept in Parquet under a dense row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.ordered import DEFAULT_WIDTH, positions


def write_change_log(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a stored log; partition columns let a resumed read skip files."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_change_log(
    spark: SparkSession, path: str, schema, start_key=None, key: str = "row_key",
    fmt: str = "parquet",
) -> DataFrame:
    """Stored rows from ``start_key`` onward; the bound reaches the file scan."""
    log = spark.read.schema(schema).format(fmt).load(path)
    return log if start_key is None else log.filter(F.col(key) >= F.lit(start_key))


def append_event_rows(
    entries: DataFrame, next_key: int = 0, by: tuple[str, ...] = ("server_id",),
    order: str = "seq", width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Dense increasing row keys continuing from the stored next key."""
    numbered = positions(entries, list(by), order, width=width)
    key = F.col("rows_before") + F.lit(next_key).cast("bigint")
    return numbered.withColumn("row_key", key).drop("rows_before")


def scan_rows(table: DataFrame, start: int, stop: int, key: str = "row_key") -> DataFrame:
    """Rows with ``start <= key < stop``."""
    return table.filter((F.col(key) >= start) & (F.col(key) < stop))


def get_rows(table: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    return table.join(keys.select(key), key, "left_semi")


def rows_exist(table: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    """Each asked-for key with whether the table has it."""
    asked = keys.select(key).distinct()
    have = table.select(key).join(asked, key, "left_semi").distinct()
    found = have.withColumn("_found", F.lit(True))
    return asked.join(found, key, "left").select(
        key, F.coalesce("_found", F.lit(False)).alias("present"))


def zip_puts(rows: DataFrame, keys: Column, values: Column, col_name: str) -> DataFrame:
    """Puts from a list of keys and a list of values; missing values are stored as null."""
    pairs = rows.select("write_seq", F.posexplode(keys).alias("_i", "row_key"), values.alias("_v"))
    return pairs.select(
        "row_key", F.lit(col_name).alias("col"), F.get("_v", F.col("_i")).alias("value"), "write_seq")


def upsert_rows(table: DataFrame, puts: DataFrame) -> DataFrame:
    """Store contents after the puts: per key and column the last write wins."""
    written = puts.select("row_key", "col", "value", "write_seq", F.lit(True).alias("is_put"))
    stored = table.select(
        "row_key", "col", "value", F.lit(0).cast("bigint").alias("write_seq"),
        F.lit(False).alias("is_put"))
    # Any put is later than what is stored, whatever its write_seq.
    newest = F.max(F.struct("is_put", "write_seq", "value")).alias("n")
    return stored.unionByName(written).groupBy("row_key", "col").agg(newest).select(
        "row_key", "col", F.col("n.value").alias("value"))


def delete_rows(table: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")

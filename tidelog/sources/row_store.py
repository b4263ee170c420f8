"""A stored change store that is updated in place, range of row keys by range.

Rows (row_key, col, value) lie in folders of ``width`` consecutive keys, sorted, with a Bloom filter
of the keys in each file. A put or a removal rewrites only the ranges it touches, each replaced at the
job's commit; repeating one that was interrupted gives the same store.

A range left without rows keeps one line without a key, as an overwrite by partition cannot leave
a folder empty; readers skip it. Null keys are not stored, put or found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.ordered import DEFAULT_WIDTH

RANGE = "key_range"
SCHEMA = f"row_key bigint, col string, value string, {RANGE} bigint"
#: Up to so many ranges or keys a condition is a list that prunes folders and files; beyond, a join.
LISTED = 10_000


def _range(width: int) -> Column:
    return F.floor(F.col("row_key") / width).cast("bigint")


def _store(rows: DataFrame, path: str) -> None:
    """Replace the ranges that ``rows`` hold. Rows are already dealt by range."""
    (rows.select("row_key", "col", "value", RANGE).sortWithinPartitions(RANGE, "row_key", "col")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.bloom.filter.enabled#row_key", "true").partitionBy(RANGE).parquet(path))


def _newest(rows: DataFrame, *more: str) -> DataFrame:
    """Per key and column the row of the last write; any put is later than what is stored."""
    last = F.max(F.struct("is_put", "write_seq", "value")).alias("n")
    return rows.groupBy(*more, "row_key", "col").agg(last).select(*more, "row_key", "col", "n.*")


def _limited(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is among those wanted (distinct, not null)."""
    listed = [r[0] for r in wanted.select(key).limit(LISTED + 1).collect()]
    if len(listed) > LISTED:
        return rows.join(wanted.select(key), key, "left_semi")
    return rows.filter(F.col(key).isin(listed))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def create_store(rows: DataFrame, path: str, width: int = DEFAULT_WIDTH) -> None:
    """A new store at ``path``, with distinct (row_key, col)."""
    keyed = rows.filter(F.col("row_key").isNotNull()).withColumn(RANGE, _range(width))
    _store(keyed.repartition(RANGE), path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path).filter(F.col("row_key").isNotNull()).drop(RANGE)


def put_rows(spark: SparkSession, path: str, puts: DataFrame, width: int = DEFAULT_WIDTH) -> None:
    """Put (row_key, col, value, write_seq): the last write of a key and column wins."""
    new = _newest(puts.filter(F.col("row_key").isNotNull()).withColumn("is_put", F.lit(True)))
    new = new.withColumn(RANGE, _range(width))
    old = _limited(_read(spark, path), new.select(RANGE).distinct(), RANGE).filter(
        F.col("row_key").isNotNull())
    old = old.withColumns({"is_put": F.lit(False), "write_seq": F.lit(None).cast(
        new.schema["write_seq"].dataType)})
    # One exchange: grouping by key keeps the deal by range.
    both = old.unionByName(new).repartition(RANGE)
    _store(_newest(both, RANGE), path)


def remove_rows(spark: SparkSession, path: str, keys: DataFrame, width: int = DEFAULT_WIDTH) -> None:
    """Remove all columns of the given keys."""
    gone = keys.select("row_key").filter(F.col("row_key").isNotNull()).distinct().withColumn(
        RANGE, _range(width))
    touched = gone.select(RANGE).distinct()
    old = _limited(_read(spark, path), touched, RANGE)
    left = old.join(gone.select("row_key"), "row_key", "left_anti").filter(
        F.col("row_key").isNotNull())
    none = F.lit(None)
    marks = touched.select(none.cast("bigint").alias("row_key"), none.cast("string").alias("col"),
                           none.cast("string").alias("value"), RANGE)
    _store(left.unionByName(marks, allowMissingColumns=True).repartition(RANGE), path)


def find_rows(spark: SparkSession, path: str, keys: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """The stored rows of the given keys. Folders are pruned by range, row groups by the keys."""
    wanted = keys.select("row_key").filter(F.col("row_key").isNotNull()).distinct().withColumn(
        RANGE, _range(width))
    rows = _limited(_read(spark, path), wanted.select(RANGE).distinct(), RANGE)
    return _limited(rows, wanted, "row_key").drop(RANGE)

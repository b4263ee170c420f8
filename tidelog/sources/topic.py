"""A stored topic whose messages are addressed by partition and offset.

Messages lie in segments, one folder per append, with dense offsets per partition. Old segments
may be removed at any time; what is left is the retained range. A consumer begins at the latest
offset, at the earliest one, or at the one it expects; an expected offset that is no longer (or
not yet) there is replaced by the latest, and messages below the start are skipped. Positions are
the consumer's own, not those of a stream's checkpoint, so a consumer may be restarted elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import DEFAULT_WIDTH, positions
from tidelog.sources.shared import written

MESSAGE = T.StructType([
    T.StructField("partition_id", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
#: The column that names a message's folder.
SEGMENT = "segment"


def _folder(spark: SparkSession, path: str):
    """A folder's file system and Hadoop path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def segments(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the segments in a folder, in order."""
    fs, at = _folder(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(SEGMENT + "="))


def _ends_path(path: str) -> str:
    """Where the next offsets after each append are, which outlive the segments."""
    return path.rstrip("/") + "-next"


def retained(spark: SparkSession, path: str) -> DataFrame:
    """partition_id, first_offset, next_offset of every partition that ever had a message; both are
    equal where nothing is left. Empty for a topic never written to."""
    ends = segments(spark, _ends_path(path))
    if not ends:
        return spark.createDataFrame([], "partition_id int, first_offset bigint, next_offset bigint")
    following = spark.read.parquet(f"{_ends_path(path)}/{SEGMENT}={ends[-1]}")
    # Two columns, whose least and greatest values the files' footers hold.
    least = spark.read.schema(MESSAGE).parquet(path).groupBy("partition_id").agg(
        F.min("offset").alias("least"))
    return following.join(least, "partition_id", "left").select(
        "partition_id", F.coalesce("least", "next_offset").alias("first_offset"), "next_offset")


def append_messages(
    messages: DataFrame, path: str, order: str, width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Append messages (partition_id, key, value, and ``order``, unique in a partition) as a segment.

    Offsets go on from the partition's next one, in the order given, also when all of its messages
    were removed; a partition of any size is numbered by ranges. The segment counts once its next
    offsets are written, so an append that was cut short is overwritten by its repeat. One writer
    at a time. Returns the retained ranges after it.
    """
    spark = messages.sparkSession
    done = segments(spark, _ends_path(path))
    number = done[-1] + 1 if done else 0
    ranges = written(retained(spark, path), "retained") if done else retained(spark, path)
    numbered = positions(messages, ["partition_id"], order, width=width)
    out = numbered.join(ranges, "partition_id", "left").select(
        F.col("partition_id").cast("int").alias("partition_id"),
        (F.coalesce("next_offset", F.lit(0)) + F.col("rows_before")).alias("offset"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    segment = f"{path.rstrip('/')}/{SEGMENT}={number}"
    out.write.mode("overwrite").parquet(segment)
    after = spark.read.schema(MESSAGE).parquet(segment).select("partition_id", (F.col(
        "offset") + 1).alias("next_offset")).unionByName(ranges.select("partition_id", "next_offset"))
    after.groupBy("partition_id").agg(F.max("next_offset").alias("next_offset")).write.mode(
        "overwrite").parquet(f"{_ends_path(path)}/{SEGMENT}={number}")
    return retained(spark, path)


def remove_segments(spark: SparkSession, path: str, before: int) -> None:
    """Remove the segments numbered below ``before``, as retention does."""
    for number in segments(spark, path):
        if number < before:
            fs, at = _folder(spark, f"{path.rstrip('/')}/{SEGMENT}={number}")
            fs.delete(at, True)


def start_offsets(
    ranges: DataFrame, expected: DataFrame | None = None, starting: str = "latest",
) -> DataFrame:
    """partition_id, start, reason: where a consumer begins in each stored partition.

    ``expected``: partition_id, offset wanted next. reason is ``expected``, ``reset`` (out of the
    retained range, so the latest) or, where nothing is expected, ``starting``.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError(f"a topic starts at latest or earliest, not at {starting!r}")
    free = F.col("next_offset" if starting == "latest" else "first_offset")
    if expected is None:
        return ranges.select("partition_id", free.alias("start"), F.lit(starting).alias("reason"))
    wish = expected.select("partition_id", F.col("offset").alias("_wish"))
    there = F.col("_wish").between(F.col("first_offset"), F.col("next_offset"))
    return ranges.join(wish, "partition_id", "left").select(
        "partition_id",
        F.when(F.col("_wish").isNull(), free).when(there, F.col("_wish")).otherwise(
            F.col("next_offset")).alias("start"),
        F.when(F.col("_wish").isNull(), F.lit(starting)).when(there, "expected").otherwise(
            "reset").alias("reason"))


def stream_topic(
    spark: SparkSession, path: str, expected: DataFrame | None = None, starting: str = "latest",
) -> DataFrame:
    """The topic as a stream, from where the consumer begins now.

    Partitions that appear later are read from their first message. The starts are one row a
    partition, stored, so every micro-batch reads the same ones.
    """
    starts = written(start_offsets(retained(spark, path), expected, starting), "topic_starts")
    stream = spark.readStream.schema(MESSAGE).parquet(path)
    return stream.join(starts.select("partition_id", "start"), "partition_id", "left").filter(
        F.col("start").isNull() | (F.col("offset") >= F.col("start"))).drop("start")


def next_offsets(consumed: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """partition_id, offset that a consumer expects after these messages."""
    after = consumed.groupBy("partition_id").agg((F.max("offset") + 1).alias("offset"))
    if before is None:
        return after
    return after.unionByName(before.select("partition_id", "offset")).groupBy("partition_id").agg(
        F.max("offset").alias("offset"))

"""Session settings these plans run best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # HotSpot leaves methods above 8,000 bytes of bytecode interpreted. Statement parsing
    # and value rendering can exceed that when fused with a whole stage; below the limit
    # Spark falls back to per-operator code, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Cell text comes in any charset of the source, with bytes that may be broken: decode it by
    # the JVM's charsets, replacing what is malformed.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    # Rows placed by (server, range) also serve a join on (server, range, more).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Groups of sorted rows are gathered in one pass; by hash, cells are sorted again for each of
    # the two halves of an aggregate as soon as a task has more than 128 groups.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Cells are packed some thirtyfold in a shuffle: partitions joined up to the default of 64 MB
    # would be sorted as about 2 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession, tz: str = "UTC") -> SparkSession:
    """Apply the settings to a running session; ``tz`` is the job's time zone."""
    for key, value in {**SETTINGS, "spark.sql.session.timeZone": tz}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark

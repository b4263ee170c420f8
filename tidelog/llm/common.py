"""Small helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII blanks, as in [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Groups above 1/HOT_SHARE of all rows are joined by broadcast: there are fewer than HOT_SHARE.
HOT_SHARE = 4096


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def letter_words(text: Column) -> Column:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a lower-cased text; null has none."""
    parts = F.split(ascii_lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def join_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str,
                total: int) -> DataFrame:
    """Give every row its group's columns. ``groups`` has one row per key, all keys occur.

    Groups of over 1/HOT_SHARE of ``total`` rows, of which there are fewer than HOT_SHARE, are
    broadcast, so no task gets a hot key; the rest are joined by shuffle. Both inputs are read
    twice: pass stored tables.
    """
    limit = max(1, math.ceil(total / HOT_SHARE))
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    some = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return some.unionByName(rest)


def partitions_for(df: DataFrame, size: float, target: int) -> int:
    """Shuffle partitions so that each gets about ``target`` of ``size``, never fewer than set."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(size / target))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, hash of the text) are in ``kept``, with their own columns
    only. ``kept``: doc, tag, copies (the rows of docs that have them) and one: whether one of these
    stays, or all.

    The pairs of ``kept`` are distinct. Those of over 1/HOT_SHARE of the rows, of which there are fewer
    than HOT_SHARE, are broadcast, and where one stays the rest goes before any shuffle.
    """
    columns = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_tag"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    kept = kept.select("doc", "tag", "copies", (F.col("one") & (F.col("copies") > 1)).alias("many"))
    total, many = kept.agg(F.sum("copies"), F.max("many")).first()
    limit = max(1, math.ceil((total or 0) / HOT_SHARE))
    hot = kept.filter(F.col("copies") > limit)
    same = F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_tag") == F.col("tag"))
    if hot.take(1):
        cold = kept.filter(F.col("copies") <= limit)
        found = rows.join(F.broadcast(hot), same).unionByName(
            rows.join(F.broadcast(hot), same, "left_anti").join(cold.hint("shuffle_hash"), same))
    else:
        found = rows.join(kept.hint("shuffle_hash"), same)
    if not many:
        return found.select(*columns)
    once = found.filter("not many").select("_row")
    more = found.filter("many").groupBy("_doc", "_tag").agg(F.first("_row").alias("_row"))
    return once.unionByName(more.select("_row")).select(*columns)

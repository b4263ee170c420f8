"""A stored topic addressed by offsets: starts, resets, removed segments, repeated appends."""

import pytest

from tidelog.sources import topic


def batch(spark, first, n, partitions=2):
    return spark.createDataFrame(
        [(k % partitions, k, None, f"v{k}") for k in range(first, first + n)],
        "partition_id int, at bigint, key string, value string")


def ranges(df):
    return {r.partition_id: (r.first_offset, r.next_offset) for r in df.collect()}


def test_offsets_go_on_after_everything_was_removed(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert topic.retained(spark, path).collect() == []
    assert ranges(topic.append_messages(batch(spark, 0, 10), path, "at", width=3)) == {0: (0, 5), 1: (0, 5)}
    assert ranges(topic.append_messages(batch(spark, 10, 4, 1), path, "at")) == {0: (0, 9), 1: (0, 5)}
    topic.remove_segments(spark, path, 1)
    assert ranges(topic.retained(spark, path)) == {0: (5, 9), 1: (5, 5)}
    topic.append_messages(batch(spark, 20, 4), path, "at")
    assert ranges(topic.retained(spark, path)) == {0: (5, 11), 1: (5, 7)}
    rows = spark.read.parquet(path).orderBy("partition_id", "offset").collect()
    assert [(r.partition_id, r.offset, r.value) for r in rows][-2:] == [(1, 5, "v21"), (1, 6, "v23")]


def test_an_append_cut_short_is_repeated(spark, tmp_path):
    path = str(tmp_path / "topic")
    topic.append_messages(batch(spark, 0, 4), path, "at")
    spark.read.parquet(f"{path}/segment=0").write.parquet(f"{path}/segment=1")  # no next offsets yet
    assert ranges(topic.append_messages(batch(spark, 4, 4), path, "at")) == {0: (0, 4), 1: (0, 4)}
    assert spark.read.parquet(path).count() == 8


def test_starts(spark):
    there = spark.createDataFrame([(0, 5, 9), (1, 5, 9), (2, 5, 9), (3, 5, 9), (4, 7, 7)],
                                  "partition_id int, first_offset bigint, next_offset bigint")
    wish = spark.createDataFrame([(0, 6), (1, 2), (2, 10), (4, 7), (9, 1)], "partition_id int, offset bigint")
    got = {r.partition_id: (r.start, r.reason) for r in topic.start_offsets(there, wish).collect()}
    assert got == {0: (6, "expected"), 1: (9, "reset"), 2: (9, "reset"), 3: (9, "latest"), 4: (7, "expected")}
    early = {r.partition_id: r.start for r in topic.start_offsets(there, starting="earliest").collect()}
    assert early == {0: 5, 1: 5, 2: 5, 3: 5, 4: 7}
    with pytest.raises(ValueError):
        topic.start_offsets(there, starting="somewhere")


def test_next_offsets(spark):
    read = spark.createDataFrame([(0, 4), (0, 7), (1, 1)], "partition_id int, offset bigint")
    before = spark.createDataFrame([(1, 9), (2, 3)], "partition_id int, offset bigint")
    got = {r.partition_id: r.offset for r in topic.next_offsets(read, before).collect()}
    assert got == {0: 8, 1: 9, 2: 3}

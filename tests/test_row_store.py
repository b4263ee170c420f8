import os

import pytest

from tidelog.sources import row_store as R
from tidelog.sources import store

WIDTH = 100
ROW, PUT = "row_key long, col string, value string", "row_key long, col string, value string, write_seq long"


def contents(df):
    return sorted(map(tuple, df.select("row_key", "col", "value").collect()), key=repr)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def made(spark, tmp_path):
    rows = spark.createDataFrame(
        [(k, c, f"{c}{k}") for k in range(-150, 1000) for c in ("a", "b")] + [(None, "a", "x")], ROW)
    path = str(tmp_path / "store")
    R.create_store(rows, path, WIDTH)
    return rows.filter("row_key is not null"), path


def test_puts_rewrite_their_ranges_only(spark, made):
    rows, path = made
    puts = spark.createDataFrame(
        [(5, "a", "new", 1), (5, "a", "newer", 2), (5, "a", "older", 0), (7, "c", None, 1),
         (7, "b", "t1", 3), (7, "b", "t2", 3), (-1, "a", "neg", -9), (5000, "a", "far", 1),
         (None, "a", "none", 1)] + [(250, "a", f"v{k}", k) for k in range(300)], PUT)
    before = files(path)
    R.put_rows(spark, path, puts, WIDTH)
    want = store.upsert_rows(rows, puts.filter("row_key is not null"))
    assert contents(R.read_store(spark, path)) == contents(want)
    changed = {os.path.basename(os.path.dirname(f)) for f in files(path) ^ before}
    assert changed == {f"key_range={k}" for k in (-1, 0, 2, 50)}
    once = contents(R.read_store(spark, path))
    R.put_rows(spark, path, puts, WIDTH)  # again: the same store
    assert contents(R.read_store(spark, path)) == once


def test_removing_whole_and_partial_ranges(spark, made):
    rows, path = made
    keys = spark.createDataFrame([(k,) for k in (*range(300, 400), 402, 402, 9999, None)], "row_key long")
    before = files(path)
    R.remove_rows(spark, path, keys, WIDTH)
    want = store.delete_rows(rows, keys.filter("row_key is not null"), "row_key")
    assert contents(R.read_store(spark, path)) == contents(want)
    changed = {os.path.basename(os.path.dirname(f)) for f in files(path) ^ before}
    assert changed == {f"key_range={k}" for k in (3, 4, 99)}
    R.put_rows(spark, path, spark.createDataFrame([(350, "a", "back", 1)], PUT), WIDTH)
    assert contents(R.find_rows(spark, path, keys, WIDTH)) == [(350, "a", "back")]


def test_lookups_skip_folders(spark, made):
    rows, path = made
    keys = spark.createDataFrame([(5,), (205,), (-150,), (4000,), (None,)], "row_key long")
    got = R.find_rows(spark, path, keys, WIDTH)
    assert contents(got) == contents(store.get_rows(rows, keys, "row_key"))
    plan = got._jdf.queryExecution().executedPlan()
    plan.execute().count()
    text = plan.toString()
    assert "PartitionFilters: [key_range" in text and "PushedFilters: [In(row_key" in text
    read = plan.collectLeaves().head().metrics().apply("numFiles").value()
    assert read <= 3 < len(files(path))


def test_many_ranges_by_join(spark, made, monkeypatch):
    monkeypatch.setattr(R, "LISTED", 2)
    rows, path = made
    keys = spark.createDataFrame([(k,) for k in range(0, 1000, 50)], "row_key long")
    assert contents(R.find_rows(spark, path, keys, WIDTH)) == contents(
        store.get_rows(rows, keys, "row_key"))
    R.remove_rows(spark, path, keys, WIDTH)
    puts = spark.createDataFrame([(k, "z", "p", 1) for k in range(0, 1000, 25)], PUT)
    R.put_rows(spark, path, puts, WIDTH)
    want = store.upsert_rows(store.delete_rows(rows, keys, "row_key"), puts)
    assert contents(R.read_store(spark, path)) == contents(want)


def test_empty(spark, tmp_path, made):
    rows, path = made
    none = spark.createDataFrame([], PUT)
    before = files(path)
    R.put_rows(spark, path, none, WIDTH)
    R.remove_rows(spark, path, none, WIDTH)
    assert files(path) == before and R.find_rows(spark, path, none, WIDTH).collect() == []

"""The range-wise helpers equal one plain window per log, whatever the skew."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import latest, positions


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    rows = []
    for server, n, step in ((1, 900, 1), (2, 40, 97), (3, 1, 1)):  # one log holds nearly all
        for i in range(n):
            rows.append((server, i * step, rng.choice("ab"), rng.random() < 0.05, rng.randrange(50)))
    return spark.createDataFrame(rows, "s int, o bigint, k string, m boolean, v int").cache()


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_latest(log, width):
    value = F.when(F.col("m"), F.col("v"))
    w = Window.partitionBy("s", "k").orderBy("o")
    want = log.withColumns({
        "a": F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "b": F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, -1))})
    got = latest(log, ["s", "k"], "o", {"a": value, "b": value}, exclusive=["b"], width=width)
    columns = ["s", "o", "a", "b"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(
        map(repr, want.select(columns).collect()))


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 20])
def test_positions(log, width):
    w = Window.partitionBy("s").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    n = F.row_number().over(Window.partitionBy("s").orderBy("o"))
    want = log.withColumn("n", n).select(
        "s", "o", (F.col("n") - 1).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum(F.col("m").cast("bigint")).over(w), F.lit(0)).alias("marks_before"),
        (F.col("n") - 1 - F.coalesce(F.max(F.when(F.col("m"), F.col("n"))).over(w), F.lit(0)))
        .cast("bigint").alias("since_mark"),
        F.coalesce(F.sum(F.col("v").cast("bigint")).over(w), F.lit(0)).alias("size_before"))
    got = positions(log, ["s"], "o", F.col("m"), size=F.col("v"), width=width)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_negative_order_values_run_backwards(log):
    back = log.withColumn("o", -F.col("o"))
    w = Window.partitionBy("s").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = back.withColumn("a", F.last("v", True).over(w)).select("s", "o", "a")
    got = latest(back, ["s"], "o", {"a": F.col("v")}, exclusive=["a"], width=13)
    assert sorted(got.select("s", "o", "a").collect()) == sorted(want.collect())


def test_one_exchange_of_the_rows(log):
    """The rows are shuffled once, by (log, range); no window is over a log alone."""
    plan = positions(log, ["s"], "o", F.col("m"), width=64)._jdf.queryExecution().sparkPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "row_number" in line:
            assert "_range" in line

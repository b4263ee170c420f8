"""Decoding that never stops, rejected events, and what runs leave behind."""

import os
import re

import pytest
from pyspark.sql import functions as F

from registry import QUERIES
from registry.base import ALLOW, Log
from tidelog import schemas as S
from tidelog.functions import values as V
from tidelog.operators import checkpoints as P
from tidelog.operators import sequence as Q
from tidelog.plans import track as H
from tidelog.session import tune
from tidelog.sources import shared
from tidelog.streaming import live

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("charset,data,text", [
    ("UTF-8", b"ab\xff", "ab�"), ("UTF-8", b"", ""), ("UTF-8", "é中".encode(), "é中"),
    ("GBK", "中文".encode("gbk"), "中文"), ("windows-1252", b"\x80uro", "€uro"),
    ("GBK", b"a\xff", "a�"),
])
def test_decode_never_stops(spark, charset, data, text):
    tune(spark)
    df = spark.createDataFrame([(bytearray(data),)], "b binary")
    assert df.select(V.decode_bytes(F.col("b"), F.lit(True), charset)["value"]).first()[0] == text


def test_entries_and_rejected_are_all_convertible_events(spark):
    log = Log(tune(spark), FOLDER)
    judged = H.judged_entries(log.raw)
    lost = H.rejected_of(judged)
    assert judged.count() == H.all_entries(log.raw).count() + lost.count()
    assert {r[0].split(":")[0] for r in lost.select("reason").distinct().collect()} == {
        "not found tableId", "no table name found"}


def test_messages_and_rejected_cover_the_kept_entries(spark):
    log = Log(tune(spark), FOLDER)
    meta = log.meta_now.filter("tbl <> 't_click'")
    messages, held, rejected = H.track_changes(log.raw, log.cells, meta, ALLOW)
    whole, free, _ = H.track_changes(log.raw, log.cells, log.meta_now, ALLOW, skip_errors=True)
    lost = rejected.filter("reason like 'no metadata%'")
    assert lost.count() > 0 and messages.count() + lost.count() == whole.count()
    # Numbers do not depend on what was rejected.
    keys = ["server_id", "seq", "batch_id", "in_id"]
    assert messages.select(keys).join(whole.select(keys), keys, "left_anti").count() == 0
    first = {r.server_id: r.s for r in rejected.groupBy("server_id").agg(
        F.min("seq").alias("s")).collect()}
    assert first and {r.server_id for r in held.collect()} <= {r.server_id for r in free.collect()}


def test_row_name_filter(spark):
    log = Log(tune(spark), FOLDER)
    rows = H.all_entries(log.raw, row_patterns=r"SHOP\..*").filter("type_code in (23,24,30,31,32)")
    assert {r.db for r in rows.select("db").distinct().collect()} == {"shop"}


def test_runs_leave_no_folders(spark):
    log = Log(tune(spark), FOLDER)
    base = shared.shared_dir(spark)
    before = sorted(os.listdir(base))
    for _ in range(2):
        with shared.run_folder(spark) as folder:
            H.track_rows(log.raw, ALLOW).write.format("noop").mode("overwrite").save()
            assert os.listdir(folder)
        assert sorted(os.listdir(base)) == before


def test_shared_folder_must_be_set_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(shared, "CHECKPOINT_SETTING", "no.such.setting")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError):
        shared.shared_dir(spark)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]


def test_context_moves_the_log_once(spark):
    """Both context windows share the first exchange: the six others carry totals only."""
    from tidelog.operators import context as C

    log = Log(tune(spark), FOLDER)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(C.resolve_table(log.raw))
        assert len(found) == 7
        assert sum("table_id" in line for line in found) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def wide_exchanges(df, columns):
    """Exchanges that carry one of the columns, as planned before the run."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", text)
    return [i for i in inputs if {c.split("#")[0].strip() for c in i.split(",")} & set(columns)]


def test_entries_cells_and_values_move_once(spark, monkeypatch):
    """Text of the log moves to its range and to its event, cells move to their event; ids,
    message numbers and finished values bring no text along again."""
    log = Log(tune(spark), FOLDER)
    found = {}
    stored, wrote = H.stored_by, shared.written

    def seen(write):
        def run(df, name, *args, **options):
            found.setdefault(name, wide_exchanges(
                df, ["query", "sql", "value", "raw_str", "raw_bin", "row_datas"]))
            return write(df, name, *args, **options)
        return run

    monkeypatch.setattr(H, "stored_by", seen(stored))
    for module in (H, Q, P):
        monkeypatch.setattr(module, "written", seen(wrote))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "8k", "spark.sql.debug.maxToStringFields": "200"}
    was = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        messages, checkpoint, _ = H.track_changes(log.raw, log.cells, log.meta_now, ALLOW)
        found["messages"] = wide_exchanges(messages, ["value"])
        found["checkpoint"] = wide_exchanges(checkpoint, ["value"])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(found["entries"]) == 1, found["entries"]  # and the write's own
    assert len(found["values"]) == 1 and "raw_long" in found["values"][0], found["values"]
    assert {k: v for k, v in found.items() if v and k not in ("entries", "values")} == {}


def event_broadcasts(df):
    """Joins on the event that send one side to the driver and every executor."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"BroadcastHashJoin \[server_id#\d+L?, seq#\d+L?\]", plan)


@pytest.mark.parametrize("name", [
    "changed_or_key_columns", "check_column_count", "effective_image", "enrich_columns",
    "flag_updated", "render_cells", "widen_unsigned", "assemble_entries"])
def test_cells_are_never_broadcast(spark, name):
    """A small file explodes into many cells, so its size says nothing about theirs."""
    assert event_broadcasts(QUERIES[name](spark, FOLDER)) == []


@pytest.mark.parametrize("resumed", [False, True])
def test_plans_broadcast_no_cells_or_entries(spark, monkeypatch, resumed):
    log, found = Log(tune(spark), FOLDER), {}
    start = None
    if resumed:
        start = spark.createDataFrame(
            [(s, "mysql-bin.000001", 50_000, 0, 0) for s in (1, 2)],
            "server_id bigint, logfile string, pos bigint, batch_id bigint, in_id bigint")

    def seen(write):
        def run(df, name, *args, **options):
            found[name] = event_broadcasts(df)
            return write(df, name, *args, **options)
        return run

    for module in (H, Q):
        monkeypatch.setattr(module, "written", seen(shared.written))
    monkeypatch.setattr(H, "stored_by", seen(shared.stored_by))
    messages, _, _ = H.track_changes(log.raw, log.cells, log.meta_now, ALLOW, checkpoints=start)
    H.track_to_store(log.raw, log.cells, log.meta_now, None)
    found["messages"] = event_broadcasts(messages)
    assert {"values", "rows", "messages"} <= set(found)
    assert {k: v for k, v in found.items() if v} == {}


def test_cells_of_a_store_are_sorted_once(spark, raw, monkeypatch):
    """Cells are sorted by row and gathered from that order: not grouped one by one to count the
    named columns, nor sorted by event first, nor numbered a second time for the checkpoint. An
    event that comes twice is stored twice."""
    tune(spark)
    event = dict(seq=20, type_code=30, table_id=1, log_pos=300)
    log = raw(dict(seq=10, type_code=19, table_id=1, db="a", tbl="t", log_pos=200), event, event,
              dict(seq=30, type_code=16, xid=5, log_pos=400))
    cells = spark.createDataFrame(
        [(1, 20, r, "A", o, 3, 0, 4, 7 + o, None, None, None) for r in (1, 0) for o in (1, 0)], S.CELL)
    meta = spark.createDataFrame(
        [("a", "t", 1, o, f"c{o}", "int", "NO", "", None, "") for o in (0, 1)], S.TABLE_META)
    plans = {}

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return shared.written(df, name)

    monkeypatch.setattr(H, "written", seen)
    rows, checkpoint, rejected = H.track_to_store(log, cells, meta, None, skip_errors=True)
    got = rows.orderBy("row_key").collect()
    assert [(r.row_key, r.seq) for r in got] == [(0, 20), (1, 20), (2, 30)]
    for r in got[:2]:  # cells meet both, as they did
        assert [[(c.name, c.value) for c in i.after] for i in r.row_datas] == 2 * [
            [("c0", "7")] * 2 + [("c1", "8")] * 2]
    assert rejected.count() == 0
    assert [tuple(r) for r in checkpoint.collect()] == [(1, "mysql-bin.000001:400", "3")]
    assert "ObjectHashAggregate" not in plans["rows"]
    assert sum(" Sort [" in line for line in plans["rows"].split("\n")) == 2, plans["rows"]
    assert not [e for e in exchanges(checkpoint) if "_range" in e]


def test_named_columns_are_counted_once(spark):
    from tidelog.operators import columns as E

    at = [(0, "B", "a"), (0, "A", "a"), (0, "A", "a"), (1, "A", None), (2, "A", "c"), (None, "A", "d")]
    cells = spark.createDataFrame(
        [(1, 1, 0, image, o, "a.t", name) for o, image, name in at],
        "server_id bigint, seq bigint, row_idx int, image string, ordinal int, _table string, name string")
    got = E.row_images(cells, ["ordinal", "name"]).first()
    assert (got["_table"], got.width, got.named, len(got.before), len(got.after)) == ("a.t", 3, 2, 1, 5)


@pytest.mark.parametrize("name", ["enrich_columns", "assemble_entries", "first_column_label"])
def test_cells_are_not_placed_by_their_table(spark, name):
    """A few tables hold all cells, so a shuffle by table would put a table's cells in one task."""
    found = exchanges(QUERIES[name](spark, FOLDER))
    assert found and not [e for e in found if "hashpartitioning(db#" in e]


def test_live_metadata_has_a_size(spark, monkeypatch, tmp_path):
    """What a micro-batch joins has a size of its own, also if the job's metadata is a list."""
    log, sizes = Log(tune(spark), FOLDER), []
    meta = spark.createDataFrame(log.meta.collect(), S.TABLE_META).groupBy("db", "tbl", "ordinal").agg(
        *[F.first(c).alias(c) for c in ("version", "name", "column_type", "column_key")])
    log.raw.withColumn("images", F.lit(None).cast(live.IMAGES)).limit(5).write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(live, "track_batch", lambda batch, epoch, meta, *rest, **options: sizes.append(
        int(meta._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
    stream = live.stream_change_log(spark, "parquet", {"path": f"{tmp_path}/in"}, live.LIVE_EVENT)
    live.track_changes_stream(
        stream, meta, ALLOW, f"{tmp_path}/state", f"{tmp_path}/sink", f"{tmp_path}/mark",
        trigger={"availableNow": True}).awaitTermination()
    assert sizes and max(sizes) < 1 << 20


def test_tables_by_key_go_with_their_run(spark):
    df = spark.range(100).selectExpr("id % 7 k", "id v")
    before = [t.name for t in spark.catalog.listTables()]
    with shared.run_folder(spark):
        table = shared.stored_by(df, "pairs", ["k"])
        assert not exchanges(table.groupBy("k").sum("v"))
        assert table.count() == 100
        assert len(spark.catalog.listTables()) == len(before) + 1
    assert [t.name for t in spark.catalog.listTables()] == before


def test_column_check_has_no_join_on_the_table(spark):
    from tidelog.operators import columns as E

    widths = spark.createDataFrame([(1, 5, "a", "t", 3), (1, 9, "a", "t", 4), (1, 9, "b", "t", 1)],
                                   "server_id bigint, seq bigint, db string, tbl string, width int")
    versions = spark.createDataFrame(
        [(1, "a", "t", 1, 1, None, 8, 2, 3), (1, "a", "t", 2, 2, 8, None, 3, None)],
        "server_id bigint, db string, tbl string, interval bigint, version bigint, "
        "valid_from bigint, valid_to bigint, meta_width int, next_width int")
    out = E.check_column_count(widths, versions)
    got = {(r.seq, r.db): (r.check, r.error) for r in out.collect()}
    assert got == {(5, "a"): ("reloaded", None), (9, "a"): (
        "error", "column size is not match for table:a.t,4 vs 3")}


def test_timestamps_in_the_jobs_zone(spark):
    df = spark.createDataFrame([(1_600_000_000, 120_000)], "s bigint, u bigint")
    got = df.select(
        V.render_timestamp(F.col("s")), V.render_timestamp(F.col("s"), "Asia/Shanghai"),
        V.render_timestamp2(F.col("s"), F.col("u"), F.lit(3), "America/New_York")).first()
    assert tuple(got) == (
        "2020-09-13 12:26:40", "2020-09-13 20:26:40", "2020-09-13 08:26:40.120")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_both_hours_of_an_autumn_night(spark, zone):
    """The zone of the session plays no part when a job names its own."""
    df = spark.createDataFrame(
        [(1635640200,), (1635643800,), (1616893200,), (0,), (None,)], "s bigint")
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = df.select(V.render_timestamp(F.col("s"), "UTC"), V.render_timestamp(F.col("s"), "Europe/Berlin"),
                        V.render_timestamp2(F.col("s"), F.lit(7_000), F.lit(4), "UTC")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    assert [r[0] for r in got] == ["2021-10-31 00:30:00", "2021-10-31 01:30:00", "2021-03-28 01:00:00",
                                   "0000-00-00 00:00:00", None]
    assert [r[1] for r in got][:3] == ["2021-10-31 02:30:00", "2021-10-31 02:30:00", "2021-03-28 03:00:00"]
    assert got[0][2] == "2021-10-31 00:30:00.0070"


def test_a_plan_shows_the_fraction_of_a_timestamp(spark):
    from tidelog.operators import columns as E
    from tidelog import schemas as S

    cells = spark.createDataFrame(
        [(1, 2, 0, "A", 0, S.WIRE["TIMESTAMP2"], 3, 4, 1_600_000_000, None, None, 120_000)],
        "server_id bigint, seq bigint, row_idx int, image string, ordinal int, mysql_type int, meta int, "
        "byte_len int, raw_long bigint, raw_str string, raw_bin binary, raw_micros bigint")
    described = cells.selectExpr("*", "false is_unsigned", "false is_text", "false is_binary")
    assert E.render_cells(described, tz="Asia/Tokyo").first().value == "2020-09-13 21:26:40.120"


@pytest.mark.parametrize("sql, changes", [
    ("ALTER TABLE t ADD c int", True), ("alter table t add (c int)", True), ("ALTER TABLE t DROP `c`", True),
    ("ALTER TABLE t DROP COLUMN c", True), ("ALTER TABLE t CHANGE a b int", True),
    ("ALTER TABLE t RENAME COLUMN a TO b", True), ("ALTER TABLE t ADD INDEX i (a)", False),
    ("ALTER TABLE t ADD UNIQUE (a), DROP FOREIGN KEY f", False), ("ALTER TABLE t ENGINE=InnoDB", False),
    ("ALTER TABLE t COMMENT 'drop column x'", False), ("ALTER TABLE `add x` ENGINE=x", False),
    ("ALTER TABLE t ADD KEY k (a), MODIFY a bigint", True), ("ALTER TABLE t RENAME INDEX a TO b", False),
])
def test_statements_that_change_columns(spark, sql, changes):
    from tidelog.functions import text as X

    df = spark.createDataFrame([(sql, "ALTER")], "q string, k string")
    assert df.select(X.changes_columns(F.col("q"), F.col("k"))).first()[0] is changes


def test_metrics_of_a_server_without_a_master_row(spark):
    from tidelog.operators import monitor as M

    log = Log(tune(spark), FOLDER)
    events = log.events.withColumn("ts", F.col("ts").cast("timestamp"))
    none = M.fetch_metrics(events, log.entries, log.master.filter("false"))
    assert none.count() > 0 and none.filter("delay_num is not null").count() == 0

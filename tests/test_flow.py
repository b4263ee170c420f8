"""Numbering, packing, checkpoints, monitoring, stores and streams."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators import checkpoints as P
from tidelog.operators import monitor as M
from tidelog.operators import sequence as Q
from tidelog.sources import publish, store
from tidelog.sources.shared import new_table_path
from tidelog.streaming import live

ENTRY = "server_id int, seq bigint, entry_type string, is_ddl boolean"


def numbered_by_hand(rows, batch, inside):
    out = []
    for _, seq, kind, ddl in rows:
        out.append((seq, batch, inside))
        inside += 1
        if kind == "TRANSACTIONEND" or (kind == "ROWDATA" and ddl):
            batch, inside = batch + 1, 0
    return out


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_batch_ids_continue_a_checkpoint(spark, width):
    rng = random.Random(1)
    rows = [(1, i * 3, rng.choice(["ROWDATA", "ROWDATA", "TRANSACTIONEND"]), rng.random() < 0.1)
            for i in range(60)]
    df = spark.createDataFrame(rows, ENTRY)
    got = Q.assign_batch_ids(df, 9, 4, width).select("seq", "batch_id", "in_id").orderBy("seq").collect()
    assert [tuple(r) for r in got] == numbered_by_hand(rows, 9, 4)


def test_one_huge_transaction_is_spread(spark):
    df = spark.range(5000).select(
        F.lit(1).alias("server_id"), F.col("id").alias("seq"), F.lit("ROWDATA").alias("entry_type"),
        F.lit(False).alias("is_ddl"))
    got = Q.assign_batch_ids(df, width=64).agg(F.max("in_id"), F.max("batch_id"), F.countDistinct("in_id")).first()
    assert tuple(got) == (4999, 0, 5000)


def packed_by_hand(sizes, max_bytes, max_rows):
    out, number, held, rows = [], 0, 0, 0
    for s in sizes:
        out.append(number)
        held, rows = held + s, rows + 1
        if held >= max_bytes or rows >= max_rows:
            number, held, rows = number + 1, 0, 0
    return out


@pytest.mark.parametrize("seed, max_bytes, max_rows, width", [
    (1, 50, 7, 8), (2, 50, 7, 7), (3, 1, 5, 8), (4, 10**9, 6, 8), (5, 200, 16, 16), (6, 300, 1000, 16),
    (7, 40, 5, 1 << 20),
])
def test_pack_messages_equals_the_greedy_fold(spark, monkeypatch, seed, max_bytes, max_rows, width):
    monkeypatch.setattr(Q, "FAN", 3)  # several levels of composition on a small log
    rng = random.Random(seed)
    logs = {1: [rng.choice([0, 1, 5, 20, 90]) for _ in range(300)], 2: [3] * 41, 3: [99]}
    rows = [(s, i * 2, v) for s, sizes in logs.items() for i, v in enumerate(sizes)]
    df = spark.createDataFrame(rows, "server_id int, seq bigint, n int").repartition(5)
    got = Q.pack_messages(df, F.col("n"), max_bytes, max_rows, width=width)
    for server, sizes in logs.items():
        mine = [r.message_no for r in got.filter(F.col("server_id") == server).orderBy("seq").collect()]
        assert mine == packed_by_hand(sizes, max_bytes, max_rows)
    whole = Q.message_summary(got, F.col("n")).agg(F.sum("n_rows"), F.sum("n_bytes")).first()
    assert tuple(whole) == (342, sum(map(sum, logs.values())))


def test_parse_and_resolve(spark):
    stored = [("a", "f.000003:10:5:6"), ("b", "f.000003:10"), ("c", ""), ("d", None), ("e", "f:x:1:2")]
    ck = spark.createDataFrame(stored, "job string, value string")
    conf = spark.createDataFrame([("c", "f.000002", 77), ("d", "f.000002", -1)], "job string, logfile string, offset bigint")
    now = spark.createDataFrame([(j, "f.000009", 500) for j in "abcdef"], "job string, logfile string, pos bigint")
    got = {r.job: (r["source"], r.logfile, r.pos, r.batch_id, r.in_id) for r in P.resolve_start(ck, conf, now).collect()}
    bad = ("invalid", None, None, None, None)
    assert got == {"a": ("checkpoint", "f.000003", 10, 5, 6), "b": bad, "e": bad,
                   "c": ("configured", "f.000002", 77, 0, 0), "d": ("master", "f.000009", 500, 0, 0),
                   "f": ("master", "f.000009", 500, 0, 0)}


@pytest.mark.parametrize("a, pa, b, pb, lag", [
    ("mysql-bin.0001234", 256986324, "mysql-bin.0001129", 32653998, 105.256986324),
    ("f.3", 50, "f.3", 20, 0.30), ("f.3", 20, "f.3", 50, 0.0), ("f.3", 20, "f.4", 50, 0.0),
    ("f.4", 20, "f.3", 20, 0.0), ("none", 1, "f.3", 2, None), ("f.0", 1, "f.3", 2, None), ("f.3", 1, "f.000", 2, None),
])
def test_position_lag(spark, a, pa, b, pb, lag):
    got = spark.range(1).select(M.position_lag(F.lit(a), F.lit(pa), F.lit(b), F.lit(pb))).first()[0]
    assert got == lag


def test_positions_compare_by_number(spark):
    cmp = lambda *v: spark.range(1).select(P.compare_positions(*map(F.lit, v))).first()[0]
    assert cmp("f.9", 5, "f.10", 1) == -1 and cmp("f.0010", 1, "f.10", 1) == 0 and cmp("f.2", 9, "f.2", 8) == 1


def test_minute_keys(spark):
    t = datetime.datetime(2024, 1, 1, 9, 58, 30)
    rows = [(1, 1, "ROWDATA", "f.1", 0, 10, 0, 1, t), (1, 2, "TRANSACTIONEND", "f.1", 10, 5, 1, 0, t + datetime.timedelta(minutes=1)),
            (1, 3, "ROWDATA", "f.1", 15, 5, 1, 1, t + datetime.timedelta(minutes=3))]
    df = spark.createDataFrame(rows, "server_id int, seq bigint, entry_type string, logfile string, logfile_offset bigint,"
                                     " event_length bigint, next_batch_id bigint, next_in_id bigint, ts timestamp")
    path = [tuple(r)[1:] for r in P.minute_checkpoints(df, "j").orderBy("key").collect()]
    assert path == [("2024-01-01/09/09:58/j", "null:-1:0:0"), ("2024-01-01/09/09:59/j", "f.1:15:1:0"),
                    ("2024-01-01/10/10:00/j", "f.1:15:1:0"), ("2024-01-01/10/10:01/j", "f.1:15:1:0")]
    assert P.minute_checkpoints(df, "j", "row_key").orderBy("key").first().key == "j##2024-01-01 09:58"


def test_replayed_entries_are_dropped(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 0), (1, 1, 1), (1, 1, 1), (2, 0, 0)], "server_id int, batch_id bigint, in_id bigint")
    seen = spark.createDataFrame([(1, 1, 0)], "server_id int, batch_id bigint, in_id bigint")
    assert sorted(map(tuple, P.dedup_replayed(df, seen).collect())) == [(1, 1, 1), (2, 0, 0)]


def test_monitor_round_trip(spark):
    df = spark.createDataFrame([(i, 2, 30, 1.5) for i in (20001, 20002, 29999)],
                               "message_id int, fetch_rows bigint, fetch_size bigint, delay_num double")
    sent = [json.loads(r.value) for r in M.monitor_messages(df, "job").collect()]
    assert [json.loads(m["content"]) for m in sent] == [{"FETCH_ROWS": 2, "FETCH_SIZE": 30, "DELAY_NUM": 1.5}, {}, {}]
    assert sent[0]["id"] == 20001 and sent[0]["mark"] == "job"
    back = M.read_monitor_messages(M.monitor_messages(df, "job").select("value")).collect()
    assert (back[0].fetch_rows, back[0].delay_num, back[1].fetch_rows) == (2, 1.5, None)


def test_shorter_value_list_stores_null(spark):
    df = spark.createDataFrame([(1, [10, 11, 12], ["a", "b"])], "write_seq bigint, k array<bigint>, v array<string>")
    puts = store.zip_puts(df, F.col("k"), F.col("v"), "c")
    assert sorted((r.row_key, r.value) for r in puts.collect()) == [(10, "a"), (11, "b"), (12, None)]
    table = spark.createDataFrame([(12, "c", "old"), (13, "c", "kept")], "row_key bigint, col string, value string")
    assert sorted(map(tuple, store.upsert_rows(table, puts).collect()), key=repr) == [
        (10, "c", "a"), (11, "c", "b"), (12, "c", None), (13, "c", "kept")]


def test_start_key_reaches_the_scan(spark):
    path = new_table_path(spark, "t")
    store.write_change_log(spark.range(100).select(F.col("id").alias("seq"), F.lit(1).alias("server_id")), path, ["server_id"])
    log = store.read_change_log(spark, path, "seq bigint, server_id int", 90, "seq").filter("server_id = 1")
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert log.count() == 10 and "GreaterThanOrEqual(seq,90)" in plan and "PartitionFilters: [isnotnull(server_id" in plan


def test_partition_by_suffix(spark):
    keys = ["192.168.2.13", "a.-7", "nodot", ".5", "h.x", "h.", "a\nb.9"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r.partition_id for r in publish.partition_by_suffix(df, "k", 5).collect()] == [3, -2, 0, 0, None, None, 4]


def test_topic_override(spark):
    df = spark.createDataFrame([(1, None), (2, "other")], "a int, t string")
    got = publish.publish_changes(df, "main", ["a"], "t").collect()
    assert [(r.topic, r.key, r.value) for r in got] == [("main", None, '{"a":1}'), ("other", None, '{"a":2}')]


def test_failed_send_repeats_and_is_not_confirmed(spark):
    source, state, mark = (new_table_path(spark, n) for n in ("in", "state", "mark"))
    schema = "server_id int, seq bigint, logfile string, logfile_offset bigint"
    spark.createDataFrame([(1, i, "f.1", i * 10) for i in range(5)], schema).write.parquet(source)
    sent = []

    def sink(batch, epoch):
        sent.append(sorted(r.seq for r in batch.collect()))
        if len(sent) == 1:
            raise RuntimeError("broker gone")

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        live.publish_at_least_once(stream, sink, state, mark, availableNow=True).awaitTermination()

    with pytest.raises(Exception):
        run()
    with pytest.raises(Exception):
        live.confirmed_positions(spark, state).collect()
    run()
    assert sent == [[0, 1, 2, 3, 4]] * 2
    assert [tuple(r) for r in live.confirmed_positions(spark, state).collect()] == [(1, 4, "f.1", 40)]


def test_tracking_a_batch_twice_leaves_it_once(spark, raw):
    """Context and ids carry over a batch edge, and a retried batch changes nothing."""
    log = raw({"seq": 1, "type_code": 4, "rotate_file": "f.000002"},
              {"seq": 2, "type_code": 19, "table_id": 7, "db": "d", "tbl": "t"},
              {"seq": 3, "type_code": 30, "table_id": 7}, {"seq": 4, "type_code": 16, "xid": 1},
              {"seq": 5, "type_code": 30, "table_id": 7}, {"seq": 6, "type_code": 30, "table_id": 7, "flags": 1},
              {"seq": 7, "type_code": 30, "table_id": 7}, {"seq": 8, "type_code": 16, "xid": 2})
    events = log.withColumn("images", F.lit(None).cast(live.IMAGES))
    meta = spark.createDataFrame([], S.TABLE_META)
    state, sink = new_table_path(spark, "state"), new_table_path(spark, "sink")
    for epoch, (low, high) in enumerate([(0, 4), (4, 7), (7, 9)]):
        part = events.filter((F.col("seq") >= low) & (F.col("seq") < high))
        for _ in range(2):
            live.track_batch(part, epoch, meta, [], state, sink)
    out = spark.read.parquet(sink).orderBy("seq").collect()
    assert [(r.seq, r.batch_id, r.in_id) for r in out] == [(3, 0, 0), (4, 0, 1), (5, 1, 0), (6, 1, 1), (8, 1, 2)]
    assert {json.loads(r.value)["logfile"] for r in out} == {"f.000002"}


def test_resuming_at_every_event_of_a_transaction(spark):
    """Cut anywhere in a transaction: what is sent again has the ids it had."""
    from registry.base import ALLOW, Log
    from tidelog.plans import track as H
    from tidelog.session import tune

    log = Log(tune(spark), "/root/testdata/sf0.001")
    judged = H.written(H.judged_entries(log.raw.filter("seq < 600")), "judged")
    entries = judged.filter("reason is null").drop("reason")
    passing = H.second_filter(entries, ALLOW, "keep")
    kept = H.written(Q.assign_batch_ids(passing), "kept")
    whole = {tuple(r) for r in kept.select("server_id", "seq", "batch_id", "in_id").collect()}
    begins = [r.seq for r in entries.filter("entry_type = 'TRANSACTIONBEGIN'").collect()]
    begin = sorted(begins)[6]
    cuts = [s for _, s, *_ in sorted(whole) if begin - 10 <= s <= begin + 50]
    assert len(cuts) >= 3
    for cut in cuts:
        at = P.make_checkpoint(
            P.last_commit(entries.filter(F.col("seq") <= cut)), kept.filter(F.col("seq") <= cut))
        again = H.continued(H.second_filter(H.resumed(entries, at), ALLOW, "keep"), at, 1 << 20)
        sent = {tuple(r) for r in again.select("server_id", "seq", "batch_id", "in_id").collect()}
        first = {x for x in whole if x[1] <= cut}
        assert sent <= whole and first | sent == whole
        seen = max(x[2:] for x in first)
        assert first | {x for x in sent if x[2:] > seen} == whole and not any(
            x in first for x in sent if x[2:] > seen)


def test_checkpoint_without_a_kept_entry_before_the_commit(spark):
    rows = [(1, 5, "TRANSACTIONEND", False, "f.1", 50, 5, 0), (1, 9, "ROWDATA", False, "f.1", 90, 5, 0)]
    entries = spark.createDataFrame(rows, "server_id int, seq bigint, entry_type string, is_ddl boolean, "
                                    "logfile string, logfile_offset bigint, event_length bigint, execute_time bigint")
    kept = entries.filter("seq = 9").withColumns({"batch_id": F.lit(7).cast("bigint"), "in_id": F.lit(4).cast("bigint")})
    starts = spark.createDataFrame([(1, 7, 4)], "server_id int, batch_id bigint, in_id bigint")
    got = P.make_checkpoint(P.last_commit(entries), kept, starts).first()
    assert got.value == "f.1:55:7:4"
    assert P.make_checkpoint(P.last_commit(entries), kept.filter("false")).collect() == []


def live_log(spark, n):
    """One server: a table map, then rows events in transactions of three."""
    from tidelog.streaming import live as L

    rows = [(1, 1, S.TABLE_MAP, 7, None, None)]
    for k in range(n):
        rows += [(1, 10 + 10 * k, 2, None, "BEGIN", None),
                 (1, 11 + 10 * k, 30, 7, None, [(0, "A", 0, 3, 0, 4, k, None, None, None)]),
                 (1, 12 + 10 * k, S.XID, None, None, None)]
    df = spark.createDataFrame(rows, "server_id bigint, seq bigint, type_code int, table_id bigint, query string, "
                               "images array<struct<row_idx:int,image:string,ordinal:int,mysql_type:int,meta:int,"
                               "byte_len:int,raw_long:bigint,raw_str:string,raw_bin:binary,raw_double:double>>")
    more = {"event_len": F.lit(10), "log_pos": F.col("seq") * 100 + 10, "flags": F.lit(0),
            "db": F.when(F.col("type_code") == S.TABLE_MAP, "d"), "tbl": F.when(
                F.col("type_code") == S.TABLE_MAP, "t"), "ts": F.lit("2024-01-01").cast("timestamp"),
            "xid": F.when(F.col("type_code") == S.XID, F.col("seq"))}
    fields = {f.name: f.dataType for f in L.LIVE_EVENT.fields}
    df = df.withColumns(more)
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                       for c, t in fields.items()])


def test_live_state_does_not_grow(spark, tmp_path):
    """Eight micro-batches leave two epochs of state; messages are packed across them."""
    import os

    meta = spark.createDataFrame([("d", "t", 1, 0, "id", "int", "NO", "PRI", None, "")], S.TABLE_META)
    state, sink = str(tmp_path / "state"), str(tmp_path / "sink")
    log = live_log(spark, 16).persist()
    for epoch in range(8):
        low, high = (0, 30) if epoch == 0 else (10 + 20 * epoch, 30 + 20 * epoch)
        part = log.filter((F.col("seq") >= low) & (F.col("seq") < high))
        live.track_batch(part, epoch, meta, ["d.t"], state, sink, max_rows=5, width=50)
        assert sorted(os.listdir(state)) == [f"epoch={k}" for k in range(max(0, epoch - 1), epoch + 1)]
    got = [tuple(r) for r in spark.read.parquet(sink).orderBy("seq").select("seq", "message_no").collect()]
    assert len(got) == 48 and [m for _, m in got] == [k // 5 for k in range(48)]
    # A batch that is run again leaves everything as it was.
    before = sorted(map(tuple, spark.read.parquet(f"{state}/epoch=7").collect()), key=str)
    live.track_batch(log.filter("seq >= 150 and seq < 170"), 7, meta, ["d.t"], state, sink, max_rows=5, width=50)
    assert sorted(map(tuple, spark.read.parquet(f"{state}/epoch=7").collect()), key=str) == before
    assert spark.read.parquet(sink).count() == 48


def test_live_start_outside_the_retained_logs(spark):
    at = spark.createDataFrame([(1, "f.000002", 50, 4, 1), (2, "f.000001", 50, 4, 1)],
                               "server_id bigint, logfile string, pos bigint, batch_id bigint, in_id bigint")
    index = spark.createDataFrame([(1, "f.000002", 4, 99), (2, "f.000002", 4, 99)],
                                  "server_id bigint, logfile string, first_pos bigint, last_pos bigint")
    master = spark.createDataFrame([(1, "f.000002", 99), (2, "f.000002", 99)],
                                   "server_id bigint, logfile string, pos bigint")
    rows = {r.server_id: r for r in live.initial_state(at, index, master).collect()}
    assert (rows[1].commit_file, rows[1].commit_pos, rows[1].next_batch_id) == ("f.000002", 50, 4)
    assert (rows[2].commit_file, rows[2].commit_pos, rows[2].next_batch_id) == ("f.000002", 99, 0)


def test_start_of_a_stream(spark, tmp_path):
    with pytest.raises(ValueError):
        live.stream_change_log(spark, "json", {"path": str(tmp_path)}, S.RAW_EVENT, starting="latest")

"""Resuming from a checkpoint and its context: files before it are not read, results are the same."""

from pyspark.sql import functions as F

from registry.base import ALLOW, Log
from tidelog import schemas as S
from tidelog.plans import resume
from tidelog.plans import track as H
from tidelog.session import tune
from tidelog.sources.shared import new_table_path, written

FOLDER = "/root/testdata/sf0.001"


def files(df):
    return {f.split("logfile=")[1].split("/")[0] for f in df.inputFiles()}


def test_files_before_the_position_are_not_read(spark):
    log = Log(tune(spark), FOLDER)
    path = new_table_path(spark, "log")
    resume.store_log(log.raw, path)
    whole = resume.read_from(spark, path)
    assert files(whole) == {"mysql-bin.000001", "mysql-bin.000002"}
    # A position in the second file, inside a transaction.
    cut = 7233
    _, at, _ = H.track_changes(log.raw.filter(F.col("seq") <= cut), log.cells, log.meta_now, ALLOW,
                               skip_errors=True)
    at = written(at, "at")
    assert at.first().logfile == "mysql-bin.000002"
    rest = resume.read_from(spark, path, at)
    # The folder's condition is part of the scan itself.
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    scanned = {r[0] for r in rest.select(F.input_file_name()).distinct().collect()}
    assert scanned and all("logfile=mysql-bin.000002" in f for f in scanned)
    seed = written(resume.context_at(whole, at), "seed")
    assert seed.count() < 20
    keys = ["server_id", "seq", "batch_id", "in_id", "value"]
    options = {"skip_errors": True, "checkpoints": at}
    pruned, after, lost = H.track_changes(rest, log.cells, log.meta_now, ALLOW, seed=seed, **options)
    full, again, missed = H.track_changes(log.raw, log.cells, log.meta_now, ALLOW, **options)
    assert sorted(map(tuple, pruned.select(keys).collect())) == sorted(map(tuple, full.select(keys).collect()))
    assert after.collect() == again.collect()
    # Events in doubt before the position were reported by the first run.
    assert {tuple(r) for r in lost.collect()} <= {tuple(r) for r in missed.collect()}


def test_context_at(spark, raw):
    """A map closed before the position is gone, a later one of the same id counts, as do changes."""
    def event(seq, code, pos, **more):
        return {"seq": seq, "type_code": code, "log_pos": pos, "event_len": 10, **more}

    rows = raw(
        event(1, S.ROTATE, 900, rotate_file="f.000002"), event(2, S.TABLE_MAP, 20, table_id=1, db="d", tbl="a"),
        event(3, 30, 30, table_id=1, flags=1), event(4, S.TABLE_MAP, 40, table_id=2, db="d", tbl="b"),
        event(5, S.TABLE_MAP, 50, table_id=2, db="d", tbl="c"),
        event(6, S.QUERY, 60, query="ALTER TABLE d.a ADD x int", session_db="d"),
        event(7, S.QUERY, 70, query="ALTER TABLE d.a ADD INDEX i (x)", session_db="d"),
        event(8, S.TABLE_MAP, 80, table_id=3, db="d", tbl="e"), event(9, S.ROTATE, 990, rotate_file="f.000003"),
        event(10, S.TABLE_MAP, 20, table_id=4, db="d", tbl="f"))
    from tidelog.operators import context as C

    events = written(C.attach_logfile(rows), "events")

    def found(seed):
        return ({(r.table_id, r.tbl) for r in seed if r.type_code == S.TABLE_MAP},
                [r.rotate_file for r in seed if r.type_code == S.ROTATE],
                {(r.db, r.tbl): r.changes for r in seed if r.type_code == S.TABLE_LINE})

    def at(file, pos):
        return spark.createDataFrame([(1, file, pos)], "server_id bigint, logfile string, pos bigint")

    first = written(resume.context_at(events, at("f.000002", 70)), "seed")
    assert found(first.collect()) == ({(2, "c")}, ["f.000002"], {("d", "a"): 1})
    # From there on, with the earlier context only.
    later = events.filter("seq > 7")
    assert found(resume.context_at(later, at("f.000003", 20), first).collect()) == (
        {(2, "c"), (3, "e"), (4, "f")}, ["f.000003"], {("d", "a"): 1})

"""Context, statements and filters on small logs."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidelog.functions import text as X
from tidelog.operators import context as C
from tidelog.operators import filters as D
from tidelog.operators import statements as T
from tidelog.plans import track as H


def test_file_before_any_rotate_is_the_default(raw):
    log = raw({"seq": 1, "type_code": 2}, {"seq": 2, "type_code": 4, "rotate_file": "f.000007"},
              {"seq": 3, "type_code": 2}, {"seq": 4, "type_code": 2, "server_id": 2})
    files = {(r.server_id, r.seq): r.logfile for r in C.attach_logfile(log, 2).collect()}
    assert files == {(1, 1): "mysql-bin.000001", (1, 2): "f.000007", (1, 3): "f.000007",
                     (2, 4): "mysql-bin.000001"}


def test_end_of_statement_closes_maps_after_itself(raw):
    def table(seq, tid, name):
        return {"seq": seq, "type_code": 19, "table_id": tid, "db": "d", "tbl": name}

    log = raw(table(1, 7, "a"), table(2, 8, "b"), {"seq": 3, "type_code": 30, "table_id": 7},
              {"seq": 4, "type_code": 31, "table_id": 8, "flags": 1},
              {"seq": 5, "type_code": 32, "table_id": 7}, table(6, 7, "c"),
              {"seq": 7, "type_code": 23, "table_id": 7})
    for width in (1, 3, 100):
        got = {r.seq: (r.tbl, r.table_error) for r in C.resolve_table(log, width).collect()}
        assert got == {3: ("a", None), 4: ("b", None), 5: (None, "not found tableId:7"), 7: ("c", None)}


def test_markers_and_statements(raw):
    log = raw({"seq": 1, "type_code": 2, "query": "x begin", "session_id": 5},
              {"seq": 2, "type_code": 2, "query": "Commit"}, {"seq": 3, "type_code": 16, "xid": 9},
              {"seq": 4, "type_code": 5, "num1": 3}, {"seq": 5, "type_code": 13, "num1": 1, "num2": 2},
              {"seq": 6, "type_code": 14, "var_name": "n"},
              {"seq": 7, "type_code": 14, "var_name": "n", "var_type": 0, "var_text": "t"},
              {"seq": 8, "type_code": 14, "var_name": "n", "var_type": 2, "var_text": "4"})
    log = log.withColumn("logfile", F.lit("f"))
    marks = {r.seq: (r.entry_type, r.thread_id, r.transaction_id) for r in C.transaction_markers(log).collect()}
    assert marks == {1: ("TRANSACTIONBEGIN", 5, None), 2: ("TRANSACTIONEND", None, "0"),
                     3: ("TRANSACTIONEND", None, "9")}
    sql = {r.seq: r.sql for r in C.statement_entries(log).collect()}
    assert sql == {4: "SET INSERT_ID = 3", 5: "SET SESSION rand_seed1 = 1 , rand_seed2 = 2",
                   6: "SET @n := NULL", 7: "SET @n := 't'", 8: "SET @n := 4"}


def test_header_offset_and_time(raw):
    log = raw({"seq": 1, "type_code": 16, "event_len": 31, "log_pos": 431,
               "ts": datetime.datetime(2024, 1, 1, 0, 0, 7, 179575)}).withColumn("logfile", F.lit("f"))
    h = C.build_header(log).first().header
    assert (h.logfile_offset, h.event_length, h.execute_time, h.schema_name) == (400, 31, 1704067207000, "")


def test_unknown_names_and_kinds(raw):
    log = raw({"seq": 1, "type_code": 164}, {"seq": 2, "type_code": 25})
    assert [r.type_name for r in C.event_type_name(log).orderBy("seq").collect()] == ["Unknown", "Delete_rows_v1"]
    got = C.row_event_kind(log).orderBy("seq").collect()
    assert [(r.event_type, r.kind_error) for r in got] == [(None, "unsupported event type: 164"), ("DELETE", None)]


@pytest.mark.parametrize("query, want", [
    ("a /* x */ b", "a   b"), ("/*a*//*b*/c", "  c"), ("a /* open", "a /* open"),
    ("/*/ x */ y", "  x */ y"), ("a /* two\nlines */b", "a  b"), ("none", "none"),
])
def test_strip_comments(spark, query, want):
    df = spark.createDataFrame([(query,)], "q string")
    assert df.select(X.strip_comments(F.col("q"))).first()[0] == want


STATEMENTS = [
    ("alter ignore table `a`.`b` add c int", "ALTER", "a", "b"),
    ("CREATE TABLE IF NOT EXISTS x.y(id int)", "CREATE", "x", "y"),
    ("create table t2 (id int)", "CREATE", "dft", "t2"),
    ("drop table if exists t3;", "ERASE", "dft", "t3"),
    ("drop temporary table t4 , t5", "ERASE", "dft", "t4"),
    ("truncate table x.t6", "TRUNCATE", "x", "t6"),
    ("truncate t7", "TRUNCATE", "dft", "t7"),
    ("create unique index i on x.t8 (c)", "CINDEX", "x", "t8"),
    ("drop index i on t9", "DINDEX", "dft", "t9"),
    ("alter table t10\nadd x int", "ALTER", "dft", "t10"),
    ("TRUNCATE TABLE ", "TRUNCATE", "dft", None),
    ("replace into t values (1)", "INSERT", "dft", None),
    ("update t set a=1", "UPDATE", "dft", None),
    ("delete from t", "DELETE", "dft", None),
    ("grant all on *.* to u", "QUERY", "dft", None),
    ("rename table a.b to c.d", "RENAME", "c", "d"),
    ("rename table t1 to t2, t3 to t4", "RENAME", "dft", "t2,"),
]


def test_statement_kind_and_table(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(STATEMENTS)], "i int, q string")
    got = df.select("i", X.statement_kind(F.col("q")).alias("k"),
                    X.statement_table(F.col("q"), F.lit("dft")).alias("t")).orderBy("i").collect()
    assert [(r.k, r.t.db, r.t.tbl) for r in got] == [s[1:] for s in STATEMENTS]


def test_rename_endpoints(spark):
    df = spark.createDataFrame([("rename table a.b to d",), ("drop table x",)], "q string")
    got = [tuple(r[0]) for r in df.select(X.rename_endpoints(F.col("q"), F.lit("s"))).collect()]
    assert got == [("s", "d", "a", "b"), (None, None, None, None)]


def test_pattern_lists(spark):
    names = ["first.test", "test.first", "coco.regex", "coco.tyhyhy", "first_test.test"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    hits = [r[0] for r in df.select(X.matches_any(F.col("n"), r"first\..*,test\..*,.*\.regex")).collect()]
    assert hits == [True, True, True, False, False]
    one = df.limit(1).select(
        X.matches_any(F.col("n"), r"first\.test.*"), X.matches_any(F.col("n"), r"FIRST\.test"),
        X.matches_any_ci(F.col("n"), r"FIRST\.Test"), X.matches_any_ci(F.col("n"), ""),
        X.matches_any_ci(F.lit(""), "zzz"), X.matches_any(F.col("n"))).first()
    assert tuple(one) == (True, False, True, True, True, True)
    assert X.pattern_list("a,bbb,cc") == "(?:a)|(?:bbb)|(?:cc)"


def test_empty_allowlists(spark):
    df = spark.createDataFrame([("d", "t"), ("", "")], "db string, tbl string")
    assert D.allow_tables(df, []).count() == 2
    assert D.allow_entries_open(df, []).count() == 2
    assert D.allow_entries_strict(df, []).count() == 0
    listed = spark.createDataFrame([("d.t",)], "dbtb string")
    assert [tuple(r) for r in D.allow_entries_strict(df, listed).collect()] == [("d", "t")]


def test_rename_passes_by_either_name(raw):
    log = raw({"seq": 1, "type_code": 2, "query": "rename table a.x to b.y", "session_db": ""},
              {"seq": 2, "type_code": 2, "query": "rename table c.x to c.y", "session_db": ""},
              {"seq": 3, "type_code": 2, "query": "drop table b.q", "session_db": ""})
    s = T.classify_statements(log)
    assert sorted(r.seq for r in T.match_ddl_tables(s, r"a\..*").collect()) == [1]
    assert sorted(r.seq for r in T.match_ddl_tables(s, r"b\..*").collect()) == [1, 3]


def test_filtered_runs(spark):
    rows = [(1, i, "d", "keep" if i == 5 else "t") for i in range(12)]
    df = spark.createDataFrame(rows, "server_id int, seq bigint, db string, tbl string")
    for width in (2, 100):
        got = D.filtered_runs(df, ["d.keep"], 3, width).orderBy("seq").collect()
        assert [(r.seq, r.run_length) for r in got] == [(2, 3), (8, 3), (11, 6)]


def test_all_entries_switches(raw):
    log = raw({"seq": 1, "type_code": 2, "query": "alter table d.t add c int", "session_db": "d"},
              {"seq": 2, "type_code": 2, "query": "insert into t values (1)", "session_db": "d"},
              {"seq": 3, "type_code": 2, "query": "grant x", "session_db": "d"},
              {"seq": 4, "type_code": 5, "num1": 1}, {"seq": 5, "type_code": 16, "xid": 1})

    def left(**switches):
        return sorted(r.seq for r in H.all_entries(log, **switches).collect())

    assert left() == [1, 2, 3, 4, 5]
    assert left(no_ddl=True) == [2, 3, 4, 5]
    assert left(no_dml=True) == [1, 3, 5]
    assert left(no_dcl=True) == [1, 2, 4, 5]
    assert left(no_ddl=True, no_dml=True, no_dcl=True) == [5]
    ddl = {r.seq: (r.event_type, r.is_ddl) for r in H.all_entries(log).collect()}
    assert ddl[1] == ("ALTER", True) and ddl[2] == ("QUERY", True) and ddl[3] == ("QUERY", False)

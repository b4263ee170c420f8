"""Values as text, against hand-worked goldens."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions import values as V
from tidelog.operators import columns as E
from tidelog.schemas import JDBC, WIRE


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def big(n):
    return F.lit(n).cast("bigint")


@pytest.mark.parametrize("size, raw, value, raised", [
    (1, -1, "255", "SMALLINT"), (2, -1, "65535", "INTEGER"), (3, -2, "16777214", "INTEGER"),
    (4, -1, "4294967295", "BIGINT"), (8, -1, "18446744073709551615", "DECIMAL"),
    (8, -(1 << 63), "9223372036854775808", "DECIMAL"), (5, -1, None, None), (1, 7, "7", None),
])
def test_widen_unsigned(spark, size, raw, value, raised):
    got = one(spark, V.widen_unsigned(big(raw), F.lit(size), F.lit(-6), F.lit(True)))
    assert (got.value, got.sql_type) == (value, JDBC[raised] if raised else -6)


def test_signed_columns_are_left_alone(spark):
    got = one(spark, V.widen_unsigned(big(-1), F.lit(1), F.lit(-6), F.lit(False)))
    assert (got.value, got.sql_type) == ("-1", -6)


@pytest.mark.parametrize("text, want", [
    ("12.50", "12.50"), ("-0.10", "-0.10"), ("1E+3", "1000"), ("1.25E1", "12.5"), ("-1.25e-3", "-0.00125"),
    ("17.25E2", "1725"),
])
def test_render_decimal(spark, text, want):
    assert one(spark, V.render_decimal(F.lit(text))) == want


@pytest.mark.parametrize("data, want", [
    (b"\x01", "1"), (b"\xff", "-1"), (b"\x01\x00", "256"), (b"\xff\xff", "65535"),
    (b"\xff" * 8, "18446744073709551615"),
])
def test_render_bit(spark, data, want):
    assert one(spark, V.render_bit(F.lit(data))) == want


@pytest.mark.parametrize("render, packed, want", [
    (V.render_datetime, 0, "0000-00-00 00:00:00"), (V.render_datetime, 20240102030405, "2024-01-02 03:04:05"),
    (V.render_datetime, 101000000, "0000-01-01 00:00:00"),
    (V.render_datetime2, 0, "0000-00-00 00:00:00"),
    (V.render_datetime2, (((2024 * 13 + 2) << 5 | 29) << 17) | (23 << 12 | 59 << 6 | 58), "2024-02-29 23:59:58"),
    (V.render_date, 0, "0000-00-00"), (V.render_date, 2024 * 512 + 12 * 32 + 31, "2024-12-31"),
    (V.render_time, 0, "00:00:00"), (V.render_time, -8385959, "-838:59:59"), (V.render_time, 123456, "12:34:56"),
    (V.render_time, 7, "00:00:07"), (V.render_time2, (838 << 12) | (59 << 6) | 59, "838:59:59"),
    (V.render_time2, -((1 << 12) | (2 << 6) | 3), "-01:02:03"), (V.render_time2, 0, "00:00:00"),
    (V.render_timestamp, 0, "0000-00-00 00:00:00"), (V.render_timestamp, 1704067207, "2024-01-01 00:00:07"),
    (V.render_year, 0, "0000"), (V.render_year, 124, "2024"),
])
def test_dates_and_times(spark, render, packed, want):
    assert one(spark, render(big(packed))) == want


def test_timestamp2_fraction(spark):
    shown = [one(spark, V.render_timestamp2(big(1), F.lit(120003), F.lit(n))) for n in (0, 2, 6)]
    assert shown == ["1970-01-01 00:00:01", "1970-01-01 00:00:01.12", "1970-01-01 00:00:01.120003"]
    assert one(spark, V.render_timestamp2(big(1), F.lit(5))) == "1970-01-01 00:00:01"


def test_decode_bytes(spark):
    data = "é".encode()
    text = one(spark, V.decode_bytes(F.lit(data), V.is_text_type(F.lit("LongText"))))
    blob = one(spark, V.decode_bytes(F.lit(data), V.is_text_type(F.lit("text(10)"))))
    assert (text.value, text.sql_type) == ("é", JDBC["CLOB"])
    assert (blob.value, blob.sql_type) == ("Ã©", JDBC["BLOB"])
    assert one(spark, V.is_binary_type(F.lit("varBinary(8)")))


@pytest.mark.parametrize("wire, meta, binary, want", [
    ("STRING", 0xF701, False, "INTEGER"), ("STRING", 0xF801, False, "BINARY"), ("STRING", 0xFE10, False, "CHAR"),
    ("STRING", 0xFE10, True, "BINARY"), ("STRING", 0xCE10, False, "CHAR"), ("STRING", 16, False, "CHAR"),
    ("BLOB", 1, False, "VARBINARY"), ("BLOB", 2, False, "LONGVARBINARY"), ("VARCHAR", 48, True, "VARBINARY"),
    ("YEAR", 0, False, "VARCHAR"), ("GEOMETRY", 4, False, "BINARY"), ("NEWDATE", 0, False, "DATE"),
])
def test_sql_type_code(spark, wire, meta, binary, want):
    assert one(spark, V.sql_type_code(F.lit(WIRE[wire]), F.lit(meta), F.lit(binary))) == JDBC[want]


def test_unknown_wire_type(spark):
    assert one(spark, V.sql_type_code(F.lit(200), F.lit(0), F.lit(False))) == JDBC["OTHER"]


CELLS = ("server_id int, seq bigint, row_idx int, image string, ordinal int, value string, event_type string,"
         " is_key boolean")


def test_flag_updated_both_forms(spark):
    rows = [(1, 1, 0, "B", 0, "x", "UPDATE", True), (1, 1, 0, "A", 0, "x", "UPDATE", True),
            (1, 1, 0, "B", 1, None, "UPDATE", False), (1, 1, 0, "A", 1, "v", "UPDATE", False),
            (1, 1, 0, "B", 2, None, "UPDATE", False), (1, 1, 0, "A", 2, None, "UPDATE", False),
            (1, 1, 0, "B", 3, "w", "UPDATE", False), (1, 1, 0, "A", 3, None, "UPDATE", False),
            (1, 1, 0, "A", 4, "new", "UPDATE", False), (1, 2, 0, "A", 0, "x", "INSERT", True)]
    cells = spark.createDataFrame(rows, CELLS)
    flat = E.flag_updated(cells)
    want = {(1, 0): False, (1, 1): True, (1, 2): False, (1, 3): True, (1, 4): False, (2, 0): False}
    assert {(r.seq, r.ordinal): r.updated for r in flat.collect() if r.image == "A"} == want
    assert not any(r.updated for r in flat.collect() if r.image == "B")
    rows_ = E.flag_updated_images(E.row_images(
        cells.withColumn("updated", F.lit(False)), ["ordinal", "value", "updated"]))
    assert {(r.seq, c.ordinal): c.updated for r in rows_.collect() for c in r.after} == want
    shown = E.changed_or_key_columns(flat).collect()
    assert sorted(r.ordinal for r in shown) == [0, 1, 3]


def test_odd_last_image_has_no_after(spark):
    images = spark.createDataFrame([(1, 1, i, f"v{i}") for i in range(3)], "server_id int, seq bigint, image_idx int, v string")
    got = E.pair_update_images(images).orderBy("row_idx").collect()
    assert [(r.before.v, r.after and r.after.v) for r in got] == [("v0", "v1"), ("v2", None)]


def test_column_count_reload_then_error(spark):
    widths = spark.createDataFrame(
        [(1, 5, "d", "t", 2), (1, 6, "d", "t", 3), (1, 7, "d", "t", 4), (1, 15, "d", "t", 3)],
        "server_id int, seq bigint, db string, tbl string, width int")
    versions = spark.createDataFrame(
        [(1, "d", "t", None, 10, 2, 3), (1, "d", "t", 10, None, 3, None)],
        "server_id int, db string, tbl string, valid_from bigint, valid_to bigint, meta_width int, next_width int")
    got = {r.seq: (r.check, r.error) for r in E.check_column_count(widths, versions).collect()}
    assert got == {5: ("ok", None), 6: ("reloaded", None), 15: ("ok", None),
                   7: ("error", "column size is not match for table:d.t,4 vs 3")}


def test_labels_and_dump(spark):
    body = "row_datas array<struct<row_idx:int,after:array<struct<name:string,value:string>>>>"
    df = spark.createDataFrame([([(0, [("id", "7"), ("x", None)])],), ([(0, [])],), (None,)], body)
    assert [r.label for r in E.first_column_label(df).collect()] == ["id ## 7", "", ""]
    m = spark.createDataFrame([({"b": None, "a": "1"},), (None,)], "m map<string,string>")
    assert [r[0] for r in m.select(E.column_dump(F.col("m"))).collect()] == ["[a,1][b,null]", ""]

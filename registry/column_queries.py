"""Rows, cells and values over the whole cell table."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import Log, register
from registry.ctes import sql
from tidelog import schemas as S
from tidelog.functions import values as V
from tidelog.operators import columns as E

_KEY = "server_id, seq, row_idx, image, ordinal"


def _big(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


@register("explode_rows", sql("""
select server_id, seq, cast(row_idx as bigint) row_idx, event_type, count(*) filter (image = 'B') n_before,
 count(*) filter (image = 'A') n_after from owned group by all""", "owned"))
def explode_rows(log: Log):
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    return E.explode_rows(log.nested).select(
        "server_id", "seq", *_big("row_idx"), "event_type",
        F.greatest(size("before"), F.lit(0)).alias("n_before"),
        F.greatest(size("after"), F.lit(0)).alias("n_after"))


@register("pair_update_images", sql("""
, im as (select server_id, seq * 10 + ordinal seq, row_idx, image, coalesce(cast(raw_long as varchar), raw_str) v from cells),
n as (select *, row_number() over (partition by server_id, seq order by row_idx, image desc) - 1 i from im)
select server_id, seq, cast(i // 2 as bigint) row_idx, max(v) filter (i % 2 = 0) before_value,
 max(v) filter (i % 2 = 1) after_value, max(image) filter (i % 2 = 1) is not null paired
from n group by server_id, seq, i // 2""", "cells"))
def pair_update_images(log: Log):
    # Every event's images in wire order, as an update event would carry them, column by column.
    cells = log.cells.withColumns({
        "seq": F.col("seq") * 10 + F.col("ordinal"),
        "v": F.coalesce(F.col("raw_long").cast("string"), "raw_str")})
    per_row = cells.groupBy("server_id", "seq", "row_idx").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.max(F.when(F.col("image") == "B", F.col("v"))).alias("b"),
        F.max(F.when(F.col("image") == "A", F.col("v"))).alias("a"))
    two = F.array(F.struct((F.col("row_idx") * 2).alias("image_idx"), F.col("b").alias("v")),
                  F.struct((F.col("row_idx") * 2 + 1).alias("image_idx"), F.col("a").alias("v")))
    one = F.array(F.struct(F.col("row_idx").alias("image_idx"), F.coalesce("a", "b").alias("v")))
    images = per_row.select(
        "server_id", "seq", F.inline(F.when(F.col("n_images") == 2, two).otherwise(one)))
    return E.pair_update_images(images).select(
        "server_id", "seq", *_big("row_idx"), F.col("before.v").alias("before_value"),
        F.col("after.v").alias("after_value"), F.col("after").isNotNull().alias("paired"))


@register("explode_columns", sql(f"""
select {_KEY.replace('row_idx', 'cast(row_idx as bigint) row_idx').replace('ordinal', 'cast(ordinal as bigint) ordinal')},
 value is null is_null, value from rendered""", "rendered"))
def explode_columns(log: Log):
    return E.explode_columns(E.explode_rows(log.nested)).select(
        "server_id", "seq", *_big("row_idx"), "image", *_big("ordinal"), "is_null", "value")


@register("enrich_columns", sql(f"""
select {_KEY}, db, tbl, name, is_key, column_type, is_unsigned from enriched""", "enriched"))
def enrich_columns(log: Log):
    return E.enrich_columns(log.owned, log.meta_now).select(
        *_KEY.split(", "), "db", "tbl", "name", "is_key", "column_type", "is_unsigned")


@register("widen_unsigned", sql(f"""
select {_KEY}, cast(case when ordinal = 4 then -4 else sql_type end as bigint) sql_type,
 case when ordinal in (0, 3) then value else cast(raw_long as varchar) end as value from rendered""", "rendered"))
def widen_unsigned(log: Log):
    # Columns that are not integers keep their type and number.
    cells = E.enrich_columns(log.owned, log.meta_now)
    base = V.sql_type_code(F.col("mysql_type"), F.col("meta"), F.lit(False))
    wide = V.widen_unsigned(F.col("raw_long"), F.col("byte_len"), base, F.col("is_unsigned"))
    return cells.withColumn("w", wide).select(
        *_KEY.split(", "), F.col("w.sql_type").cast("bigint").alias("sql_type"), "w.value")


@register("render_cells", sql(f"""
select {_KEY}, cast(sql_type as bigint) sql_type, value from rendered""", "rendered"))
def render_cells(log: Log):
    return log.rendered.select(*_KEY.split(", "), *_big("sql_type"), "value")


# One cell per event, its type each wire type in turn and its raw value as that type is sent.
_Y, _M, _D, _H, _MI = "(2000 + k % 30)", "(1 + k % 12)", "(1 + k % 28)", "(k % 24)", "(k % 60)"
_DATE = f"{_Y}, {_M}, {_D}"
_BYTES = {"TINY": 1, "SHORT": 2, "INT24": 3, "LONG": 4, "LONGLONG": 8}
_RAW_LONG = {
    "DATETIME": f"{_Y} * 10000000000 + {_M} * 100000000 + {_D} * 1000000 + {_H} * 10000 + {_MI} * 101",
    "DATETIME2": f"({_Y} * 13 + {_M}) * 4194304 + {_D} * 131072 + {_H} * 4096 + {_MI} * 65",
    "TIMESTAMP": "1600000000 + k", "TIMESTAMP2": "1600000000 + k",
    "DATE": f"{_Y} * 512 + {_M} * 32 + {_D}", "NEWDATE": "k + 1", "YEAR": "1 + k % 200",
    "TIME": f"-({_H} * 10000 + {_MI} * 101) - 10000", "TIME2": f"-({_H} * 4096 + {_MI} * 65) - 4096",
    "ENUM": "k % 5", **{t: "-1 - k % 100" for t in _BYTES},
}
_RAW_TEXT = {t: "'t' || k" for t in ("VARCHAR", "VAR_STRING", "STRING", "SET")} | {
    "NEWDECIMAL": "k || '.50'", "DECIMAL": "k || '.5'"}
_BINARY = ("TINY_BLOB", "MEDIUM_BLOB", "LONG_BLOB", "BLOB", "GEOMETRY")


def _case(values: dict) -> str:
    return "case t " + " ".join(f"when {S.WIRE[n]} then {v}" for n, v in values.items()) + " end"


_TEXT_SQL = {
    **{t: f"cast(case when u then (-1 - k % 100)::hugeint + (1::hugeint << {8 * b}) else -1 - k % 100 end as varchar)"
       for t, b in _BYTES.items()},
    "DATETIME": f"printf('%04d-%02d-%02d %02d:%02d:%02d', {_DATE}, {_H}, {_MI}, {_MI})",
    "DATETIME2": f"printf('%04d-%02d-%02d %02d:%02d:%02d', {_DATE}, {_H}, {_MI}, {_MI})",
    **{t: "strftime(make_timestamp((1600000000 + k) * 1000000), '%Y-%m-%d %H:%M:%S')"
       for t in ("TIMESTAMP", "TIMESTAMP2")},
    "DATE": f"printf('%04d-%02d-%02d', {_DATE})", "NEWDATE": "cast(k + 1 as varchar)",
    "YEAR": "cast(1901 + k % 200 as varchar)",
    "TIME": f"printf('-%02d:%02d:%02d', {_H} + 1, {_MI}, {_MI})",
    "TIME2": f"printf('-%02d:%02d:%02d', {_H} + 1, {_MI}, {_MI})",
    "ENUM": "cast(k % 5 as varchar)", "BIT": "cast(256 + k % 60000 as varchar)",
    "FLOAT": "cast((k % 1000) / 4.0 as varchar)", "DOUBLE": "cast((k % 1000) / 4.0 as varchar)",
    **{t: f"cast({v} as varchar)" for t, v in _RAW_TEXT.items()}, **{t: "'b' || k" for t in _BINARY},
}
_CODE_SQL = {
    "TINY": "case when u then 5 else -6 end", "SHORT": "case when u then 4 else 5 end",
    "INT24": "4", "LONG": "case when u then -5 else 4 end", "LONGLONG": "case when u then 3 else -5 end",
    "DATETIME": 93, "DATETIME2": 93, "TIMESTAMP": 93, "TIMESTAMP2": 93, "DATE": 91, "NEWDATE": 91,
    "YEAR": 12, "TIME": 92, "TIME2": 92, "ENUM": 4, "BIT": -7, "FLOAT": 7, "DOUBLE": 8, "VARCHAR": 12,
    "VAR_STRING": 12, "STRING": 1, "NEWDECIMAL": 3, "DECIMAL": 3, "SET": 2004,
    **{t: "case when u then 2005 else 2004 end" for t in _BINARY},
}
_WIRE_LIST = "[" + ",".join(map(str, S.WIRE.values())) + "]"


@register("render_every_type", f"""
with c as (select event_id k, {_WIRE_LIST}[event_id % {len(S.WIRE)} + 1] t, (event_id // {len(S.WIRE)}) % 2 = 1 u from events)
select k, cast(t as bigint) t, cast({_case(_CODE_SQL)} as bigint) sql_type, {_case(_TEXT_SQL)} as value from c""")
def render_every_type(log: Log):
    """All wire types through the renderer: unsigned or text columns at every other turn."""
    n = len(S.WIRE)
    cells = log.table("events").select(
        F.col("event_id").alias("k"),
        F.get(F.array(*map(F.lit, S.WIRE.values())), (F.col("event_id") % n).cast("int")).alias("t"),
        ((F.call_function("div", F.col("event_id"), F.lit(n).cast("bigint")) % 2) == 1).alias("u"))
    text = _case(_RAW_TEXT | {t: "'b' || k" for t in _BINARY})
    cells = cells.selectExpr(
        "k", "t", "u", "t mysql_type", "case when t = 15 then 48 when t = 252 then 2 else 0 end meta",
        f"cast(coalesce({_case(_BYTES)}, 0) as int) byte_len",
        f"cast({_case(_RAW_LONG)} as bigint) raw_long",
        f"case when t not in ({', '.join(str(S.WIRE[t]) for t in _BINARY)}) then {text} end raw_str",
        f"case when t = {S.WIRE['BIT']} then unhex(lpad(hex(256 + k % 60000), 4, '0')) "
        f"when t in ({', '.join(str(S.WIRE[t]) for t in _BINARY)}) then cast({text} as binary) end raw_bin",
        f"case when t in ({S.WIRE['FLOAT']}, {S.WIRE['DOUBLE']}) then (k % 1000) / 4.0d end raw_double",
        "u is_unsigned", f"u and t <> {S.WIRE['SET']} is_text", "false is_binary")
    return E.render_cells(cells, tz="UTC").select("k", *_big("t", "sql_type"), "value")


@register("decode_text_blob", """
select doc_id, case when doc_id % 3 = 0 then 2004 else 2005 end::bigint sql_type,
 case when doc_id % 3 = 0 then null else md5(text || chr(65533)) end text_md5,
 case when doc_id % 3 = 0 then strlen(text) else length(text) end::bigint + 1 n_chars
from documents""")
def decode_text_blob(log: Log):
    # Text types come back as text; a blob has one character per byte. Every value ends in a
    # byte that is no UTF-8.
    i = F.col("doc_id") % 3
    kind = F.when(i == 0, "blob").when(i == 1, "text").otherwise("MEDIUMTEXT")
    docs = log.table("documents").withColumn(
        "d", V.decode_bytes(
            F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))), V.is_text_type(kind)))
    return docs.select(
        "doc_id", F.col("d.sql_type").cast("bigint").alias("sql_type"),
        F.when(i != 0, F.md5("d.value")).alias("text_md5"),
        F.length("d.value").cast("bigint").alias("n_chars"))


_WIRE = list(S.WIRE.values()) + [200]
_WIRE_SQL = "[" + ",".join(map(str, _WIRE)) + "]"


@register("sql_type_code", f"""
with w as (select p_partkey, {_WIRE_SQL}[p_partkey % {len(_WIRE)} + 1] t0,
 case p_partkey % 5 when 0 then p_size when 1 then 63488 + p_size when 2 then 63232 + p_size
  when 3 then 65024 + p_size else 52736 + p_size end meta, p_partkey % 3 = 0 bin from part),
x as (select *, meta // 256 hi from w),
y as (select *, case when t0 = 254 and meta >= 256 then case when hi & 48 <> 48 then hi | 48
  when hi in (247, 248, 254) then hi else t0 end else t0 end t from x)
select p_partkey, case t when 3 then 4 when 1 then -6 when 2 then 5 when 9 then 4 when 8 then -5 when 0 then 3
 when 246 then 3 when 4 then 7 when 5 then 8 when 16 then -7 when 7 then 93 when 17 then 93 when 12 then 93
 when 18 then 93 when 11 then 92 when 19 then 92 when 14 then 91 when 10 then 91 when 13 then 12 when 247 then 4
 when 248 then -2 when 255 then -2
 when 249 then case meta when 1 then -3 else -4 end when 250 then case meta when 1 then -3 else -4 end
 when 251 then case meta when 1 then -3 else -4 end when 252 then case meta when 1 then -3 else -4 end
 when 15 then case when bin then -3 else 12 end when 253 then case when bin then -3 else 12 end
 when 254 then case when bin then -2 else 1 end else 1111 end::bigint sql_type from y""")
def sql_type_code(log: Log):
    k, size = F.col("p_partkey"), F.col("p_size")
    wire = F.get(F.array(*[F.lit(w) for w in _WIRE]), (k % len(_WIRE)).cast("int"))
    base = F.get(F.array(*[F.lit(b) for b in (0, 63488, 63232, 65024, 52736)]), (k % 5).cast("int"))
    code = V.sql_type_code(F.col("wire"), F.col("meta"), k % 3 == 0)
    return log.table("part").withColumns({"wire": wire, "meta": base + size}).select(
        "p_partkey", code.cast("bigint").alias("sql_type"))


@register("render_numeric", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_linenumber % 6
 when 0 then cast(l_quantity as bigint) || '.25'
 when 1 then format('{:.3f}', (l_quantity + 0.25) / 10) when 2 then format('{:.4f}', (l_quantity + 0.25) / 100)
 when 3 then format('{:.1f}', (l_quantity + 0.25) * 10)
 when 4 then cast(cast((l_quantity + 0.25) * 10000 as bigint) as varchar)
 else '-' || cast(cast((l_quantity + 0.25) * 100 as bigint) as varchar) end as value from lineitem""")
def render_numeric(log: Log):
    n = F.col("l_linenumber") % 6
    base = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".25"))
    suffix = {0: "", 1: "E-1", 2: "e-2", 3: "E1", 4: "E+4", 5: "E2"}
    text = F.lit(None).cast("string")
    for i, s in suffix.items():
        text = F.when(n == i, F.concat(F.lit("-" if i == 5 else ""), base, F.lit(s))).otherwise(text)
    return log.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        V.render_decimal(text).alias("value"))


@register("render_bit", """
with v as (select o_orderkey, 1 + o_orderkey % 4 n, (o_orderkey * 7919) % cast(pow(256, 1 + o_orderkey % 4) as bigint) x
 from orders)
select o_orderkey, cast(case when n = 1 and x > 127 then x - 256 else x end as varchar) as value from v""")
def render_bit(log: Log):
    n = F.col("o_orderkey") % 4 + 1
    x = F.col("o_orderkey") * 7919 % F.get(
        F.array(*[F.lit(256 ** i) for i in (1, 2, 3, 4)]), (n - 1).cast("int"))
    data = F.unhex(F.lpad(F.hex(x), (n * 2).cast("int"), F.lit("0")))
    return log.table("orders").select("o_orderkey", V.render_bit(data).alias("value"))


# Packed values come from order dates with a spread time of day; zero now and then.
_STAMP_SQL = """with s as (select o_orderkey, o_orderkey % 97 = 0 z,
 o_orderdate + to_seconds(o_orderkey * 7919 % 86400) t from orders) """


def _stamps(log: Log):
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 7919 % 86400
    return log.table("orders").select(
        "o_orderkey", (F.col("o_orderkey") % 97 == 0).alias("z"),
        F.timestamp_seconds(seconds).alias("t"), seconds.alias("sec"))


def _parts():
    t = F.col("t")
    return [f(t).cast("bigint") for f in (F.year, F.month, F.day, F.hour, F.minute, F.second)]


def _packed(log: Log, value, render):
    packed = F.when(F.col("z"), F.lit(0)).otherwise(value).cast("bigint")
    return _stamps(log).select("o_orderkey", packed.alias("p")).select(
        "o_orderkey", render(F.col("p")).alias("value"))


_DATETIME_SQL = _STAMP_SQL + """select o_orderkey, case when z then '0000-00-00 00:00:00'
 else strftime(t, '%Y-%m-%d %H:%M:%S') end as value from s"""


@register("render_datetime", _DATETIME_SQL)
def render_datetime(log: Log):
    y, m, d, h, i, s = _parts()
    value = ((((y * 100 + m) * 100 + d) * 100 + h) * 100 + i) * 100 + s
    return _packed(log, value, V.render_datetime)


@register("render_datetime2", _DATETIME_SQL)
def render_datetime2(log: Log):
    y, m, d, h, i, s = _parts()
    value = ((y * 13 + m) * 32 + d) * (1 << 17) + (h * 64 + i) * 64 + s
    return _packed(log, value, V.render_datetime2)


@register("render_date", _STAMP_SQL + """select o_orderkey, case when z then '0000-00-00'
 else strftime(t, '%Y-%m-%d') end as value from s""")
def render_date(log: Log):
    y, m, d, *_ = _parts()
    return _packed(log, y * 512 + m * 32 + d, V.render_date)


_TIME_SQL = """with s as (select o_orderkey, o_orderkey % 97 = 0 z, case when o_orderkey % 2 = 1 then '-' else '' end sign,
 1 + o_custkey * 7919 % 3020398 v from orders)
select o_orderkey, case when z then '00:00:00'
 else printf('%s%02d:%02d:%02d', sign, v // 3600, v // 60 % 60, v % 60) end as value from s"""


def _times(log: Log, pack, render):
    sign = F.when(F.col("o_orderkey") % 2 == 1, -1).otherwise(1)
    v = F.col("o_custkey") * 7919 % 3020398 + 1
    div = lambda a, b: F.call_function("div", a, F.lit(b).cast("bigint"))
    value = sign * pack(div(v, 3600), div(v, 60) % 60, v % 60)
    packed = F.when(F.col("o_orderkey") % 97 == 0, F.lit(0)).otherwise(value).cast("bigint")
    return log.table("orders").select("o_orderkey", packed.alias("p")).select(
        "o_orderkey", render(F.col("p")).alias("value"))


@register("render_time", _TIME_SQL)
def render_time(log: Log):
    return _times(log, lambda h, m, s: (h * 100 + m) * 100 + s, V.render_time)


@register("render_time2", _TIME_SQL)
def render_time2(log: Log):
    return _times(log, lambda h, m, s: (h * 64 + m) * 64 + s, V.render_time2)


@register("render_timestamp", _DATETIME_SQL)
def render_timestamp(log: Log):
    return _packed(log, F.col("sec"), V.render_timestamp)


@register("render_timestamp2", _STAMP_SQL + """select o_orderkey, case when z then '0000-00-00 00:00:00'
 when o_orderkey % 7 = 0 then strftime(t, '%Y-%m-%d %H:%M:%S')
 else strftime(t, '%Y-%m-%d %H:%M:%S') || '.' || left(lpad(cast(o_orderkey * 104729 % 1000000 as varchar), 6, '0'),
  cast(o_orderkey % 7 as int)) end as value from s""")
def render_timestamp2(log: Log):
    sec = F.when(F.col("z"), F.lit(0)).otherwise(F.col("sec")).cast("bigint")
    micros, fsp = F.col("o_orderkey") * 104729 % 1000000, (F.col("o_orderkey") % 7).cast("int")
    return _stamps(log).select("o_orderkey", sec.alias("p")).select(
        "o_orderkey", V.render_timestamp2(F.col("p"), micros, fsp).alias("value"))


@register("render_year", _STAMP_SQL + """select o_orderkey, case when z then '0000' else cast(year(t) as varchar) end
 as value from s""")
def render_year(log: Log):
    return _packed(log, F.year("t") - 1900, V.render_year)


@register("render_enum_set", """
select p_partkey, cast(4 as bigint) sql_type, cast(p_size as varchar) as value, 'a' || p_size set_value from part""")
def render_enum_set(log: Log):
    cells = log.table("part").select(
        "p_partkey", F.lit(S.WIRE["STRING"]).alias("mysql_type"), F.lit(0xF701).alias("meta"),
        F.lit(1).alias("byte_len"), F.col("p_size").cast("bigint").alias("raw_long"),
        F.lit(None).cast("string").alias("raw_str"), F.lit(None).cast("binary").alias("raw_bin"),
        F.lit(False).alias("is_unsigned"), F.lit(False).alias("is_text"),
        F.lit(False).alias("is_binary"),
        F.encode(F.concat(F.lit("a"), F.col("p_size").cast("string")), "UTF-8").alias("bits"))
    return E.render_cells(cells).select(
        "p_partkey", *_big("sql_type"), "value",
        V.decode_bytes(F.col("bits"), F.lit(False))["value"].alias("set_value"))


@register("flag_updated", sql(f"select {_KEY}, value, updated from flagged", "flagged"))
def flag_updated(log: Log):
    return log.flagged.select(*_KEY.split(", "), "value", "updated")


@register("effective_image", sql(f"""
select {_KEY}, event_type, raw_str from owned
where image = case when event_type = 'DELETE' then 'B' else 'A' end""", "owned"))
def effective_image(log: Log):
    return E.effective_image(log.owned).select(*_KEY.split(", "), "event_type", "raw_str")


@register("changed_or_key_columns", sql("""
select server_id, seq, row_idx, ordinal, name, value, column_type from flagged
where event_type = 'UPDATE' and image = 'A' and (is_key or updated)""", "flagged"))
def changed_or_key_columns(log: Log):
    return E.changed_or_key_columns(log.flagged).select(
        "server_id", "seq", "row_idx", "ordinal", "name", "value", "column_type")


_ITEM = """{'ordinal': ordinal, 'sql_type': sql_type, 'name': name, 'is_key': is_key, 'updated': updated,
 'is_null': value is null, 'value': value, 'mysql_type': column_type}"""
ROWS_JSON = f"""
, per_row as (select server_id, seq, row_idx,
 coalesce(list({_ITEM} order by ordinal) filter (image = 'B'), []) "before",
 coalesce(list({_ITEM} order by ordinal) filter (image = 'A'), []) "after" from flagged group by all),
nested as (select server_id, seq, list({{'row_idx': row_idx, 'before': "before", 'after': "after"}} order by row_idx)
 row_datas from per_row group by all)"""


@register("assemble_entries", sql(ROWS_JSON + """
select server_id, seq, cast(to_json(row_datas) as varchar) as body from nested""", "flagged"))
def assemble_entries(log: Log):
    body = F.to_json("row_datas", {"ignoreNullFields": "false"})
    return log.nested.select("server_id", "seq", body.alias("body"))


@register("simple_entries", sql("""
select server_id, seq, logfile, logfile_offset, execute_time ts, event_length event_len, event_type, entry_type,
 nullif(trim(db), '') database_name, nullif(trim(tbl), '') table_name from entries
where type_code in (16,23,24,25,30,31,32)""", "entries"))
def simple_entries(log: Log):
    return E.simple_entries(log.entries)


@register("flat_event_entries", sql("""
, e as (select server_id, seq, row_idx, db, tbl, event_type, image, string_agg('"' || name || '":' ||
 coalesce(cast(to_json(value) as varchar), 'null'), ',' order by ordinal) j from flagged group by all)
select server_id, seq, cast(row_idx as bigint) row_idx, seq as mid, any_value(db) db, any_value(db) sch, any_value(tbl) tab,
 any_value(event_type) opt, any_value(h.execute_time) ts, null::varchar ddl, null::varchar err,
 '{' || max(j) filter (image = 'B') || '}' src, '{' || max(j) filter (image = 'A') || '}' cur, null::varchar cus
from e join hdr h using (server_id, seq) group by server_id, seq, row_idx""", "flagged", "hdr"))
def flat_event_entries(log: Log):
    flat = E.flat_event_entries(log.nested)
    return flat.withColumns({c: F.to_json(c) for c in ("src", "cur", "cus")}).withColumn(
        "row_idx", F.col("row_idx").cast("bigint"))


@register("column_dump", sql("""
, e as (select server_id, seq, row_idx, image,
 string_agg('[' || name || ',' || coalesce(value, 'null') || ']', '' order by name) j from flagged group by all)
select server_id, seq, cast(row_idx as bigint) row_idx, coalesce(max(j) filter (image = 'B'), '') src_text,
 coalesce(max(j) filter (image = 'A'), '') cur_text from e group by 1, 2, 3""", "flagged"))
def column_dump(log: Log):
    return E.flat_event_entries(log.nested).select(
        "server_id", "seq", *_big("row_idx"), E.column_dump(F.col("src")).alias("src_text"),
        E.column_dump(F.col("cur")).alias("cur_text"))


@register("first_column_label", sql("""
select server_id, seq, coalesce(max('id ## ' || value) filter (image = 'A' and row_idx = 0 and ordinal = 0), '') label
from flagged group by 1, 2""", "flagged"))
def first_column_label(log: Log):
    return E.first_column_label(log.nested).select("server_id", "seq", "label")

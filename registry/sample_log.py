"""A change log derived from an ``events`` table, in one scan.

Every event gives a table map and a rows event; some also a rotate, BEGIN, other
query, xid, statement or ignored event. ``seq = event_id * 10 + slot``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas as S

EVENTS_PER_FILE = 500
STATEMENTS = [
    "/* c */ ALTER TABLE `shop`.`t_user` ADD c int",
    "create table if not exists t_new(id int)",
    "DROP TABLE IF EXISTS crm.t_old;",
    "truncate t_misc",
    "RENAME TABLE shop.t_a TO crm.t_b",
    "CREATE UNIQUE INDEX ix ON t_user (id)",
    "update t_user set a=1",
    "DROP INDEX ix ON crm.t_misc",
    "ALTER IGNORE TABLE crm.t_misc ADD COLUMN d int",
    "insert into t_order values (1)",
    "REPLACE INTO t_order VALUES (2)",
    "delete from crm.t_click where id=3",
    "GRANT SELECT ON *.* TO app",
    "COMMIT",
    "CREATE TEMPORARY TABLE crm.`t_tmp` (id int)",
    "ALTER TABLE /* a */ t_order /* b */ ADD e int",
    "ALTER TABLE t_order\nADD f int",
    "TRUNCATE TABLE ",
    "rename table t_x to t_y, t_p to t_q",
    "set @a=1 /* open",
    "/*/ drop table shop.t_click */ select 1",
    "MERGE INTO t_order USING t_x",
    "  begin",
    "ALTER TABLE shop.t_order ADD COLUMN g int",
    "ALTER TABLE `shop`.`t_user` ADD INDEX ix_kind (kind), DROP PRIMARY KEY",
    "alter table crm.t_misc comment 'add column x'",
    "ALTER TABLE shop.t_user DROP KEY ix_kind, MODIFY kind varchar(32)",
]
TABLES = [("shop", "t_user"), ("shop", "t_order"), ("crm", "t_click"), ("crm", "t_misc")]
META_COLUMNS = [
    ("id", "bigint(20) unsigned", "PRI"), ("kind", "varchar(16)", ""),
    ("amount", "decimal(10,2)", ""), ("small", "tinyint(3) unsigned", ""),
    ("note", "text", ""), ("at", "datetime", ""),
]
ALLOW = ["shop.t_user", "crm.t_click"]


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def server_of(event_id: Column) -> Column:
    """One busy server holds two of every three files."""
    return F.when(_div(event_id, EVENTS_PER_FILE) % 3 == 2, 2).otherwise(1)


def raw_log(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    slots = F.array_compact(F.array(
        F.when((e % EVENTS_PER_FILE == 0) & (e > 0), 0), F.when(e % 5 == 0, 1),
        F.lit(2), F.lit(3), F.when(e % 50 == 7, 4), F.when(e % 5 == 4, 5),
        F.when(e % 40 == 11, 6), F.when(e % 100 == 50, 7),
    ))
    x = events.select("event_id", "ts", "user_id", "event_type", F.explode(slots).alias("k"))
    k, sub = F.col("k"), _div(e, 40) % 7
    rows_code = _pick_code(F.col("event_type"))
    mapped = (F.col("user_id") + F.when(e % 7 == 3, 1).otherwise(0)) % 4
    misc = _pick([29, 160, 5, 13, 14, 14, 14], sub)
    code = (
        F.when(k == 0, 4).when(k == 2, 19).when(k == 3, rows_code).when(k == 5, 16)
        .when(k == 6, misc).when(k == 7, _pick([15, 27, 33, 3], _div(e, 100) % 4)).otherwise(2)
    )
    length = e % 37 * 3 + 100
    file_no = _div(e, EVENTS_PER_FILE) + 1
    is6 = k == 6
    cols: dict[str, Column] = {
        "server_id": server_of(e).cast("bigint"),
        "seq": e * 10 + k,
        "type_code": code,
        "event_len": length,
        "log_pos": (e % EVENTS_PER_FILE * 10 + k) * 200 + 4 + length,
        "flags": F.when((k == 3) & (e % 20 == 19), 1).otherwise(0),
        "rotate_file": F.when(k == 0, F.concat(
            F.lit("mysql-bin."), F.lpad(file_no.cast("string"), 6, "0"))),
        "table_id": F.when(k == 2, mapped + 100).when(
            k == 3, F.when(e % 101 == 7, F.lit(999)).otherwise(F.col("user_id") % 4 + 100)),
        "db": F.when(k == 2, _pick([d for d, _ in TABLES], mapped)),
        "tbl": F.when(k == 2, _pick([t for _, t in TABLES], mapped)),
        "query": F.when(k == 1, "BEGIN")
                  .when(k == 4, _pick(STATEMENTS, _div(e, 50) % len(STATEMENTS)))
                  .when(is6 & (sub < 2), F.concat(F.lit("insert into t_order values ("),
                                                  e.cast("string"), F.lit(")"))),
        "session_id": F.when(k.isin(1, 4), e % 1000 + 1),
        "session_db": F.when(k.isin(1, 4), F.when(e % 3 == 0, "").otherwise("shop")),
        "xid": F.when(k == 5, e * 7),
        "var_name": F.when(is6 & (sub >= 4), F.concat(F.lit("v"), (e % 9).cast("string"))),
        "var_type": F.when(is6 & (sub >= 4), F.when(sub == 6, 1).otherwise(0)),
        "var_text": F.when(is6 & (sub == 5), "it").when(
            is6 & (sub == 6), F.concat((e % 10).cast("string"), F.lit(".5"))),
        "num1": F.when(is6 & sub.isin(2, 3), e * 3),
        "num2": F.when(is6 & (sub == 3), e * 5),
        "ts": F.col("ts"),
    }
    return x.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in S.RAW_EVENT.fields])


def _pick_code(event_type: Column) -> Column:
    return (
        F.when(event_type == "signup", 30).when(event_type == "view", 23)
        .when(event_type == "purchase", 31).when(event_type == "click", 24).otherwise(32)
    )


def cell_table(events: DataFrame) -> DataFrame:
    """Long-form row images: six columns per image, 1 to 3 rows per event."""
    e, kind = F.col("event_id"), F.col("event_type")
    images = (
        F.when(kind.isin("signup", "view"), F.array(F.lit("A")))
        .when(kind.isin("purchase", "click"), F.array(F.lit("B"), F.lit("A")))
        .otherwise(F.array(F.lit("B")))
    )
    rows = events.select(
        "*", F.explode(F.sequence(F.lit(0), (e % 3).cast("int"))).alias("row_idx"), images.alias("im"))
    sides = rows.select("*", F.explode("im").alias("image")).drop("im")
    g = sides.select("*", F.explode(F.array(*[F.lit(i) for i in range(6)])).alias("ordinal"))
    o, is_after, r = F.col("ordinal"), F.col("image") == "A", F.col("row_idx")
    stamp = F.date_format(F.col("ts"), "yyyyMMddHHmmss").cast("bigint")
    cols: dict[str, Column] = {
        "server_id": server_of(e).cast("bigint"),
        "seq": e * 10 + 3,
        "row_idx": r, "image": F.col("image"), "ordinal": o,
        "mysql_type": _pick([8, 15, 246, 1, 252, 12], o),
        "meta": _pick([0, 48, 2562, 0, 2, 0], o),
        "byte_len": _pick([8, 0, 0, 1, 0, 8], o),
        "raw_long": F.when(o == 0, F.when(e % 13 == 0, -1 - F.col("user_id")).otherwise(F.col("user_id")))
                     .when(o == 3, (e * 7 + r + F.when(is_after, e % 2 * 13).otherwise(0)) % 256 - 128)
                     .when(o == 5, F.when(e % 97 == 0, F.lit(0)).otherwise(stamp)),
        "raw_str": F.when(o == 1, F.when(~((e % 11 == 0) & ~is_after), kind))
                    .when(o == 2, (F.col("value") + F.when(is_after, r).otherwise(0))
                          .cast("decimal(10,2)").cast("string"))
                    .when(o == 4, F.col("props")),
        "raw_bin": F.lit(None),
        "raw_double": F.lit(None),
    }
    return g.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in S.CELL.fields])


def table_meta(spark: SparkSession) -> DataFrame:
    """Metadata of the four tables; crm.t_misc had one column less in version 1."""
    rows = []
    for db, tbl in TABLES:
        for version, width in ((1, 5), (2, 6)) if tbl == "t_misc" else ((1, 6),):
            rows += [
                (db, tbl, version, i, name, kind, "NO" if key else "YES", key, None, "")
                for i, (name, kind, key) in enumerate(META_COLUMNS[:width])
            ]
    return spark.createDataFrame(rows, S.TABLE_META)


def current_meta(meta: DataFrame) -> DataFrame:
    """The newest version of each table's metadata."""
    newest = meta.groupBy("db", "tbl").agg(F.max("version").alias("version"))
    return meta.join(newest, ["db", "tbl", "version"])

"""Numbering, checkpoints, monitoring, stores, messages, streams and whole plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import ALLOW, WIDTH, Log, newest, register
from registry.column_queries import ROWS_JSON
from registry.ctes import sql
from tidelog import schemas as S
from tidelog.operators import checkpoints as P
from tidelog.operators import context as C
from tidelog.operators import monitor as M
from tidelog.operators import sequence as Q
from tidelog.operators.ordered import merged
from tidelog.plans import resume
from tidelog.plans import track as H
from tidelog.sources import publish, row_store, store, topic
from tidelog.sources.shared import new_table_path, written
from tidelog.streaming import live

NOW_MS = 1_710_000_000_000
MAX_BYTES, MAX_ROWS = 20_000, 150


def _big(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _packed_sql(source: str, size: str, keys: str, max_bytes: int = MAX_BYTES) -> str:
    """Greedy batches: the end of a message starting anywhere, then a walk over starts."""
    return f"""
, idx as (select {keys}, {size} sz, row_number() over (partition by server_id order by seq) i,
  sum({size}) over (partition by server_id order by seq) cum from {source}),
stop as (select a.server_id, a.i, least(a.i + {MAX_ROWS} - 1, coalesce(b.i, a.i + {MAX_ROWS})) e
 from idx a asof left join idx b on a.server_id = b.server_id and a.cum - a.sz + {max_bytes} <= b.cum),
walk(server_id, no, s, e) as (select server_id, 0::bigint, i, e from stop where i = 1
 union all select w.server_id, w.no + 1, n.i, n.e from walk w join stop n on n.server_id = w.server_id and n.i = w.e + 1),
packed as (select idx.*, w.no message_no from idx join walk w on idx.server_id = w.server_id and idx.i between w.s and w.e)
"""


# --- Numbering and packing ---------------------------------------------------

@register("assign_batch_ids", sql(
    "select server_id, seq, entry_type, batch_id + 7 batch_id, in_id + case when batch_id = 0 then 3 else 0 end in_id"
    " from numbered", "numbered"))
def assign_batch_ids(log: Log):
    kept = H.kept_entries(log.raw, ALLOW, markers="keep", batch0=7, in0=3, width=WIDTH)
    return kept.select("server_id", "seq", "entry_type", "batch_id", "in_id")


@register("pack_messages", sql(
    _packed_sql("numbered", "event_length", "server_id, seq") +
    "select server_id, seq, message_no from packed", "numbered"))
def pack_messages(log: Log):
    packed = Q.pack_messages(log.numbered, F.col("event_length"), MAX_BYTES, MAX_ROWS, width=2_000)
    return packed.select("server_id", "seq", "message_no")


@register("last_commit", sql("""
, p as (select 'transaction_end' rule, * from entries where entry_type = 'TRANSACTIONEND'
 union all select 'any_entry', * from entries
 union all select 'end_event', * from entries where type_code = 16 or (type_code = 2 and entry_type <> 'TRANSACTIONBEGIN'))
select rule, server_id, max(seq) seq, arg_max(logfile, seq) logfile, arg_max(logfile_offset, seq) logfile_offset,
 arg_max(event_length, seq) event_length, arg_max(execute_time, seq) execute_time from p group by 1, 2""", "entries"))
def last_commit(log: Log):
    entries = written(log.entries, "entries")
    parts = [P.last_commit(entries, r).select(F.lit(r).alias("rule"), "*") for r in P.COMMIT_RULES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CHECKPOINT_CTE = """
, c as (select server_id, max(seq) seq, arg_max(logfile, seq) logfile, arg_max(logfile_offset + event_length, seq) pos
 from entries where entry_type = 'TRANSACTIONEND' group by 1),
n as (select server_id, coalesce(arg_max(case when is_end then batch_id + 1 else batch_id end, n.seq)
  filter (n.seq <= c.seq), 0) batch_id, coalesce(arg_max(case when is_end then 0 else in_id + 1 end, n.seq)
  filter (n.seq <= c.seq), 0) in_id from numbered n join c using (server_id) group by 1),
ck as (select server_id, logfile, pos, batch_id, in_id,
 logfile || ':' || pos || ':' || batch_id || ':' || in_id as value from c join n using (server_id))
"""


@register("make_checkpoint", sql(_CHECKPOINT_CTE + "select * from ck", "entries", "numbered"))
def make_checkpoint(log: Log):
    return P.make_checkpoint(P.last_commit(log.entries), log.numbered)


# --- Positions and checkpoints -----------------------------------------------

_VALUES_SQL = """
, v as (select server_id, seq, case seq % 5 when 0 then logfile || ':' || log_pos || ':1:2' when 1 then logfile || ':' || log_pos
 when 2 then '' when 3 then logfile || ':x:1:2' when 4 then 'old.000099:' || log_pos || ':' || seq || ':0' end as value
 from logfiles)"""


def _values(log: Log):
    at = F.concat(F.col("logfile"), F.lit(":"), F.col("log_pos").cast("string"))
    pick = [F.concat(at, F.lit(":1:2")), at, F.lit(""), F.concat(F.col("logfile"), F.lit(":x:1:2")),
            F.concat(F.lit("old.000099:"), F.col("log_pos").cast("string"), F.lit(":"),
                     F.col("seq").cast("string"), F.lit(":0"))]
    return log.events.withColumn("value", F.get(F.array(*pick), (F.col("seq") % 5).cast("int")))


@register("parse_checkpoint", sql(_VALUES_SQL + """
select server_id, seq, ok valid, case when ok then split_part(value, ':', 1) end logfile,
 cast(case when ok then split_part(value, ':', 2) end as bigint) pos,
 cast(case when ok then split_part(value, ':', 3) end as bigint) batch_id,
 cast(case when ok then split_part(value, ':', 4) end as bigint) in_id
from (select *, seq % 5 in (0, 4) ok from v)""", "logfiles"))
def parse_checkpoint(log: Log):
    return _values(log).select(
        "server_id", "seq", P.parse_checkpoint(F.col("value")).alias("c")).select(
        "server_id", "seq", "c.*")


# One job per customer: some with a stored value, some configured, some with neither.
@register("resolve_start", """
with j as (select *, 'job' || c_custkey job, case c_custkey % 4 when 0 then 'mysql-bin.000003:' || c_custkey || ':5:6'
  when 1 then '' when 2 then 'mysql-bin.000003:' || c_custkey end as value,
  case when c_custkey % 3 = 0 then -1 else c_custkey * 10 end o from customer)
select job, src "source", case src when 'checkpoint' then 'mysql-bin.000003' when 'configured' then 'mysql-bin.000002'
  when 'master' then 'mysql-bin.000009' end logfile,
 case src when 'checkpoint' then c_custkey when 'configured' then o when 'master' then c_custkey * 100 end pos,
 case src when 'checkpoint' then 5 when 'invalid' then null else 0 end::bigint batch_id,
 case src when 'checkpoint' then 6 when 'invalid' then null else 0 end::bigint in_id
from (select *, case when c_custkey % 4 = 0 then 'checkpoint' when c_custkey % 4 = 2 then 'invalid'
  when c_custkey % 5 <> 0 and o > 0 then 'configured' else 'master' end src from j)""")
def resolve_start(log: Log):
    k = F.col("c_custkey")
    jobs = log.table("customer").select("c_custkey", F.concat(F.lit("job"), k.cast("string")).alias("job"))
    text = F.concat(F.lit("mysql-bin.000003:"), k.cast("string"))
    stored = jobs.filter(k % 4 != 3).select("job", F.when(k % 4 == 0, F.concat(text, F.lit(":5:6")))
                                            .when(k % 4 == 1, "").otherwise(text).alias("value"))
    conf = jobs.filter(k % 5 != 0).select(
        "job", F.lit("mysql-bin.000002").alias("logfile"),
        F.when(k % 3 == 0, F.lit(-1)).otherwise(k * 10).cast("bigint").alias("offset"))
    master = jobs.select("job", F.lit("mysql-bin.000009").alias("logfile"), (k * 100).alias("pos"))
    return P.resolve_start(stored, conf, master)


@register("compare_positions", sql("""
select server_id, seq, cast(case when f > 10 or (f = 10 and log_pos > 500000) then 1
 when f = 10 and log_pos = 500000 then 0 else -1 end as bigint) cmp
from (select *, cast(right(logfile, 6) as int) f from logfiles)""", "logfiles"))
def compare_positions(log: Log):
    cmp = P.compare_positions(
        F.col("logfile"), F.col("log_pos"), F.lit("mysql-bin.10"), F.lit(500_000))
    return log.events.select("server_id", "seq", cmp.cast("bigint").alias("cmp"))


@register("resume_from", sql("""
, k as (select server_id, min(logfile) logfile, 300000 pos from logfiles where logfile > 'mysql-bin.000005' group by 1)
select e.server_id, e.seq, e.logfile, e.logfile_offset from entries e join k using (server_id)
where e.logfile > k.logfile or (e.logfile = k.logfile and e.logfile_offset >= k.pos)""", "entries"))
def resume_from(log: Log):
    ckpt = log.events.filter(F.col("logfile") > "mysql-bin.000005").groupBy("server_id").agg(
        F.min("logfile").alias("logfile"), F.lit(300_000).cast("bigint").alias("pos"))
    return P.resume_from(log.entries, ckpt).select("server_id", "seq", "logfile", "logfile_offset")


def _with_next(log: Log):
    """Every entry with the ids following it and its event time."""
    n = H.kept_entries(log.raw, [], markers="keep", width=WIDTH)
    ends = Q.ends_batch()
    return n.withColumns({
        "next_batch_id": F.col("batch_id") + F.when(ends, 1).otherwise(0),
        "next_in_id": F.when(ends, F.lit(0)).otherwise(F.col("in_id") + 1),
        "ts": F.timestamp_millis("execute_time"),
    })


@register("minute_checkpoints", sql("""
, a as (select *, entry_type = 'TRANSACTIONEND' or is_ddl is_end2 from entries),
b as (select *, coalesce(sum(is_end2::int) over (partition by server_id order by seq
  rows between unbounded preceding and 1 preceding), 0)::bigint b from a),
ends as (select server_id, seq, logfile || ':' || (logfile_offset + event_length) || ':' || (b + 1) || ':0' v,
  execute_time // 60000 m from b where entry_type = 'TRANSACTIONEND'),
per as (select server_id, m, arg_max(v, seq) v from ends group by 1, 2),
span as (select server_id, min(execute_time // 60000) lo, max(execute_time // 60000) hi from entries group by 1),
spine as (select server_id, unnest(range(lo, hi + 1)) m from span),
filled as (select server_id, m, last_value(v ignore nulls) over (partition by server_id order by m) v
 from spine left join per using (server_id, m))
select server_id, strftime(make_timestamp(m * 60000000), '%Y-%m-%d/%H/%H:%M') || '/job1' "key",
 coalesce(v, 'null:-1:0:0') as value from filled""", "entries"))
def minute_checkpoints(log: Log):
    return P.minute_checkpoints(_with_next(log), "job1", width=WIDTH)


@register("dedup_replayed", sql("""
select server_id, seq, batch_id, in_id from numbered where batch_id > 40 or (batch_id = 40 and in_id > 1)""", "numbered"))
def dedup_replayed(log: Log):
    entries = written(log.numbered, "numbered")
    seen = entries.select("server_id").distinct().select(
        "server_id", F.lit(40).cast("bigint").alias("batch_id"), F.lit(1).cast("bigint").alias("in_id"))
    again = entries.unionByName(entries.filter(F.col("batch_id") >= 30))
    return P.dedup_replayed(again, seen).select("server_id", "seq", "batch_id", "in_id")


@register("validate_checkpoint", sql("""
, c as (select server_id, logfile, log_pos + case when seq % 10 = 5 then 5000000 else 0 end pos, seq,
 case when seq % 10 = 2 then 'gone.000001' else logfile end f from logfiles)
select 'e' || seq job, c.server_id, ok retained, case when ok then c.f else m.logfile end logfile,
 case when ok then c.pos else m.pos end pos, case when ok then 4 else 0 end::bigint batch_id,
 case when ok then 2 else 0 end::bigint in_id
from (select c.*, coalesce(c.pos between i.first_pos and i.last_pos, false) ok from c
 left join log_index i on i.server_id = c.server_id and i.logfile = c.f) c join master m using (server_id)""",
    "log_index", "master", "logfiles"))
def validate_checkpoint(log: Log):
    k = F.col("seq") % 10
    c = log.events.select(
        F.concat(F.lit("e"), F.col("seq").cast("string")).alias("job"), "server_id",
        F.when(k == 2, "gone.000001").otherwise(F.col("logfile")).alias("logfile"),
        (F.col("log_pos") + F.when(k == 5, 5_000_000).otherwise(0)).alias("pos"),
        F.lit(4).cast("bigint").alias("batch_id"), F.lit(2).cast("bigint").alias("in_id"))
    return P.validate_checkpoint(c, log.log_index, log.master)


# --- Monitoring --------------------------------------------------------------

_LAG_SQL = """case when a is null or b is null or a = 0 or b = 0 then null when pa = pb then 0.0
 else greatest(0.0, cast(cast(a - b as varchar) || '.' || cast(case when a - b <> 0 then pa else greatest(pa - pb, 0) end
  as varchar) as double)) end"""


@register("position_lag", sql(f"""
select server_id, seq, {_LAG_SQL} lag from (select l.server_id, l.seq, cast(right(m.logfile, 6) as bigint) a, m.pos pa,
 case when l.seq % 17 = 0 then null else cast(right(l.logfile, 6) as bigint) end b, l.log_pos pb
 from logfiles l join master m using (server_id))""", "logfiles", "master"))
def position_lag(log: Log):
    m = log.master.select("server_id", F.col("logfile").alias("mf"), "pos")
    name = F.when(F.col("seq") % 17 == 0, "mysql-bin").otherwise(F.col("logfile"))
    lag = M.position_lag(F.col("mf"), F.col("pos"), name, F.col("log_pos"))
    return log.events.join(m, "server_id").select("server_id", "seq", lag.alias("lag"))


@register("fetch_metrics", sql(f"""
, e as (select server_id, date_trunc('minute', ts) minute_start, count(*) n, sum(event_length)::bigint b from entries
 where type_code not in (23,24,25,30,31,32) or db || '.' || tbl in ('shop.t_user', 'crm.t_click') group by 1, 2),
p as (select server_id, date_trunc('minute', ts) minute_start, arg_max(logfile, seq) lf, arg_max(log_pos, seq) pb
 from logfiles group by 1, 2),
w as (select p.*, coalesce(n, 0) fetch_rows, coalesce(b, 0) fetch_size from p left join e using (server_id, minute_start))
select server_id, minute_start, fetch_rows, fetch_size, fetch_size / 1048576 fetch_mb, {_LAG_SQL} delay_num
from (select w.*, cast(right(m.logfile, 6) as bigint) a, m.pos pa, cast(right(lf, 6) as bigint) b
 from w join master m using (server_id))""", "logfiles", "entries", "master"))
def fetch_metrics(log: Log):
    # Context is attached once, for the positions, the entries and the newest position.
    events = written(C.resolved_events(log.raw, WIDTH), "events")
    entries = H.judged_events(events, ALLOW).filter("reason is null")
    out = M.fetch_metrics(
        events.withColumn("ts", F.col("ts").cast("timestamp")), entries, newest(events))
    return out.withColumn("minute_start", F.col("minute_start").cast("timestamp_ntz"))


@register("send_metrics", sql(
    _packed_sql("listed_numbered", "event_length", "server_id, seq") + f"""
select m.server_id, message_no, send_rows, send_size, 0::bigint send_time, {NOW_MS} - c.execute_time delay_time
from (select server_id, message_no, count(*) send_rows, sum(sz)::bigint send_size, max(seq) seq from packed group by 1, 2) m
asof left join (select server_id, seq, execute_time from entries where entry_type = 'TRANSACTIONEND') c
 on m.server_id = c.server_id and m.seq >= c.seq""",
    "listed_numbered", "entries"))
def send_metrics(log: Log):
    # Markers are dropped, so most messages hold no commit of their own.
    listed = H.kept_entries(log.raw, ALLOW, markers="drop", width=WIDTH)
    packed = Q.pack_messages(listed, F.col("event_length"), MAX_BYTES, MAX_ROWS, width=WIDTH)
    return M.send_metrics(packed, log.entries, F.col("event_length"), F.lit(NOW_MS), width=WIDTH)


@register("entry_delay", sql(
    f"select server_id, seq, {NOW_MS} - execute_time delay_ms from entries", "entries"))
def entry_delay(log: Log):
    return M.entry_delay(log.entries, F.lit(NOW_MS)).select("server_id", "seq", "delay_ms")


@register("over_stock", sql("""
select m.server_id, m.pos + 12345 - arg_max(l.log_pos, l.seq) over_stock
from master m join logfiles l using (server_id) group by m.server_id, m.pos""", "master", "logfiles"))
def over_stock(log: Log):
    ahead = log.master.withColumn("pos", F.col("pos") + 12345)
    return M.over_stock(log.raw, ahead)


def _monitor(log: Log):
    minutes = log.events.groupBy("server_id", F.date_trunc("minute", "ts").alias("w")).agg(
        F.count(F.lit(1)).alias("fetch_rows"), F.sum("event_len").alias("fetch_size"),
        F.min("seq").alias("seq"))
    return minutes.select(
        "server_id", "seq", (F.lit(20000) + F.col("seq") % 6).cast("int").alias("message_id"),
        "fetch_rows", "fetch_size", F.lit(1.5).alias("delay_num"),
        F.col("fetch_rows").alias("send_rows"), F.col("fetch_size").alias("send_size"),
        F.lit(3).cast("bigint").alias("send_time"), F.col("seq").alias("delay_time"),
        F.concat(F.lit("e\"x"), F.col("seq").cast("string")).alias("exception"),
        F.lit("10.0.0.1").alias("ip"))


_MONITOR_SQL = """
, w as (select server_id, date_trunc('minute', ts) m, count(*) n, sum(event_len)::bigint b, min(seq) seq
 from logfiles group by 1, 2), k as (select *, cast(20000 + seq % 6 as bigint) message_id from w)"""


# Message ids and field names of the envelope, as in tidelog/operators/monitor.py.
@register("monitor_messages", sql(_MONITOR_SQL + """
, c as (select *, case message_id when 20001 then to_json({'FETCH_ROWS': n, 'FETCH_SIZE': b, 'DELAY_NUM': 1.5::double})
 when 20002 then to_json({'SEND_ROWS': n, 'SEND_SIZE': b, 'SEND_TIME': 3, 'DELAY_TIME': seq})
 when 20003 then to_json({'EXCEPTION': 'e"x' || seq}) when 20004 then to_json({'IP': '10.0.0.1'}) else '{}' end content from k),
l as (select *, case message_id when 20000 then to_json({'FETCH_ROWS': n, 'FETCH_SIZE': b})
 when 20001 then to_json({'SEND_ROWS': n, 'SEND_SIZE': b, 'SEND_TIME': 3, 'DELAY_TIME': seq}) else '{}' end content from k)
select 'online' form, server_id, seq, cast(to_json({'id': message_id, 'mark': 'job1', 'content': content::varchar}) as varchar) as value from c
union all select 'legacy', server_id, seq, cast(to_json({'id': message_id, 'mark': 'job1', 'content': content::varchar}) as varchar) from l""",
    "logfiles"))
def monitor_messages(log: Log):
    metrics = _monitor(log)
    parts = [M.monitor_messages(metrics, "job1", form).select(
        F.lit(form).alias("form"), "server_id", "seq", "value") for form in ("online", "legacy")]
    return parts[0].unionByName(parts[1])


@register("read_monitor_messages", sql(_MONITOR_SQL + """
select server_id, seq, message_id, 'job1' job, case when message_id = 20001 then n end fetch_rows,
 case when message_id = 20001 then b end fetch_size, case when message_id = 20001 then 1.5::double end delay_num,
 case when message_id = 20002 then n end send_rows, case when message_id = 20002 then b end send_size,
 case when message_id = 20002 then 3 end::bigint send_time, case when message_id = 20002 then seq end delay_time,
 case when message_id = 20003 then 'e"x' || seq end as exception, case when message_id = 20004 then '10.0.0.1' end ip
from k""", "logfiles"))
def read_monitor_messages(log: Log):
    sent = M.monitor_messages(_monitor(log), "job1").select("server_id", "seq", "value")
    return M.read_monitor_messages(sent).withColumn("message_id", F.col("message_id").cast("bigint"))


# --- Store and messages ------------------------------------------------------

@register("read_change_log", sql(
    "select server_id, seq, type_code, log_pos from raw where seq >= 20000", "raw"))
def read_change_log(log: Log):
    path = new_table_path(log.spark, "log")
    store.write_change_log(log.raw, path, ["server_id"])
    return store.read_change_log(log.spark, path, S.RAW_EVENT, 20_000, "seq").select(
        "server_id", "seq", "type_code", "log_pos")


@register("append_event_rows", sql("""
select server_id, seq, 999 + row_number() over (partition by server_id order by seq) row_key from entries""", "entries"))
def append_event_rows(log: Log):
    return store.append_event_rows(log.entries, 1000, width=WIDTH).select("server_id", "seq", "row_key")


@register("scan_rows", sql("""
select * from (select server_id, seq, row_number() over (partition by server_id order by seq) - 1 row_key from entries)
where row_key >= 500 and row_key < 2500""", "entries"))
def scan_rows(log: Log):
    keyed = store.append_event_rows(log.entries, width=WIDTH).select("server_id", "seq", "row_key")
    return store.scan_rows(keyed, 500, 2500)


@register("get_rows", """
select o_orderkey, o_custkey, o_orderstatus from orders where o_orderkey in (select user_id * 7 from events)""")
def get_rows(log: Log):
    keys = log.table("events").select((F.col("user_id") * 7).alias("o_orderkey"))
    orders = log.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return store.get_rows(orders, keys, "o_orderkey")


@register("rows_exist", """
select k o_orderkey, k in (select o_orderkey from orders) present from (select distinct event_id * 3 k from events)""")
def rows_exist(log: Log):
    keys = log.table("events").select((F.col("event_id") * 3).alias("o_orderkey"))
    return store.rows_exist(log.table("orders"), keys, "o_orderkey")


@register("upsert_rows", """
with a as (select o_orderkey row_key, 'status' col, o_orderstatus as value, -1 ws from orders
 union all select l_orderkey, case when l_linenumber % 2 = 0 then 'status' else 'flag' end, l_returnflag || l_linestatus,
 cast(epoch(l_shipdate) as bigint) from lineitem)
select row_key, col, value from (select *, row_number() over (partition by row_key, col order by ws desc, value desc) rn
 from a) where rn = 1""")
def upsert_rows(log: Log):
    table = log.table("orders").select(
        F.col("o_orderkey").alias("row_key"), F.lit("status").alias("col"),
        F.col("o_orderstatus").alias("value"))
    puts = log.table("lineitem").select(
        F.col("l_orderkey").alias("row_key"),
        F.when(F.col("l_linenumber") % 2 == 0, "status").otherwise("flag").alias("col"),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("write_seq"))
    return store.upsert_rows(table, puts)


@register("delete_rows", """
select o_orderkey, o_custkey from orders where o_orderkey not in (select event_id * 2 from events)""")
def delete_rows(log: Log):
    keys = log.table("events").select((F.col("event_id") * 2).alias("o_orderkey"))
    return store.delete_rows(log.table("orders").select("o_orderkey", "o_custkey"), keys, "o_orderkey")


@register("store_in_place", """
with a as (select o_orderkey row_key, 'status' col, o_orderstatus as value, -1 ws from orders
 union all select l_orderkey, case when l_linenumber % 2 = 0 then 'status' else 'flag' end, l_returnflag || l_linestatus,
 cast(epoch(l_shipdate) as bigint) from lineitem where l_orderkey % 3 = 0),
b as (select row_key, col, value from (select *, row_number() over (partition by row_key, col order by ws desc, value desc) rn
 from a) where rn = 1 and row_key not in (select event_id * 2 from events where event_id % 5 = 0))
select row_key, col, value from b where row_key in (select user_id * 7 from events) or row_key % 2 = 1""")
def store_in_place(log: Log):
    """A stored table after puts and removals: its odd keys, and the keys asked for."""
    path = new_table_path(log.spark, "store")
    row_store.create_store(log.table("orders").select(
        F.col("o_orderkey").alias("row_key"), F.lit("status").alias("col"),
        F.col("o_orderstatus").alias("value")), path, WIDTH)
    row_store.put_rows(log.spark, path, log.table("lineitem").filter("l_orderkey % 3 = 0").select(
        F.col("l_orderkey").alias("row_key"),
        F.when(F.col("l_linenumber") % 2 == 0, "status").otherwise("flag").alias("col"),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("write_seq")), WIDTH)
    row_store.remove_rows(log.spark, path, log.table("events").filter("event_id % 5 = 0").select(
        (F.col("event_id") * 2).alias("row_key")), WIDTH)
    keys = log.table("events").select((F.col("user_id") * 7).alias("row_key"))
    asked = row_store.find_rows(log.spark, path, keys, WIDTH).filter("row_key % 2 = 0")
    return asked.unionByName(row_store.read_store(log.spark, path).filter("row_key % 2 = 1"))


@register("partition_by_suffix", """
with k as (select c_custkey, case c_custkey % 5 when 0 then 'nodot' || c_custkey when 1 then '.' || c_custkey
 when 2 then '10.2.' || c_custkey when 3 then 'a.-' || c_custkey else 'h.' || c_custkey || 'x' end k from customer)
select c_custkey, k as "key", case c_custkey % 5 when 0 then 0 when 1 then 0 when 2 then c_custkey % 7
 when 3 then -(c_custkey % 7) end::bigint partition_id from k""")
def partition_by_suffix(log: Log):
    k = F.col("c_custkey")
    forms = [("nodot", ""), (".", ""), ("10.2.", ""), ("a.-", ""), ("h.", "x")]
    key = F.get(F.array(*[F.concat(F.lit(a), k.cast("string"), F.lit(b)) for a, b in forms]),
                (k % 5).cast("int"))
    keyed = log.table("customer").select("c_custkey", key.alias("key"))
    return publish.partition_by_suffix(keyed, "key", 7).withColumn(
        "partition_id", F.col("partition_id").cast("bigint"))


@register("publish_changes", sql("""
select server_id, seq, case when is_ddl then 'ddl' else 'changes' end topic, null::varchar as "key",
 cast(to_json({'server_id': server_id, 'seq': seq, 'logfile': logfile, 'logfile_offset': logfile_offset, 'db': db,
 'tbl': tbl, 'event_type': event_type, 'entry_type': entry_type, 'is_ddl': is_ddl, 'sql': sql}) as varchar) as value
from entries""", "entries"))
def publish_changes(log: Log):
    routed = log.entries.withColumn("to", F.when(F.col("is_ddl"), "ddl"))
    columns = ["server_id", "seq", "logfile", "logfile_offset", "db", "tbl", "event_type",
               "entry_type", "is_ddl", "sql"]
    return publish.publish_changes(routed, "changes", columns, "to", keep=("server_id", "seq"))


# --- Streams -----------------------------------------------------------------

@register("stream_change_log", sql(
    "select server_id, seq, type_code, event_len, log_pos, query from raw where seq >= 100", "raw"))
def stream_change_log(log: Log):
    source, out, mark = (new_table_path(log.spark, n) for n in ("source", "copy", "mark"))
    log.raw.write.json(source)
    stream = live.stream_change_log(log.spark, "json", {"path": source}, S.RAW_EVENT, expected=100)
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return log.spark.read.parquet(out).select(
        "server_id", "seq", "type_code", "event_len", "log_pos", "query")


@register("stream_topic", """
with m as (select event_id, event_id % 3 p, row_number() over (partition by event_id % 3 order by event_id) - 1 o,
 event_id * 4 // (select max(event_id) + 1 from events) seg from events),
s as (select min(o) + 5 start from m where p = 1 and seg = 2)
select 1 run, p partition_id, o as "offset", event_id::varchar as value from m where seg = 0
union all select 2, p, o, event_id::varchar from m, s where seg = 3 or (p = 1 and seg = 2 and o >= s.start)""")
def stream_topic(log: Log):
    """A consumer reads a topic from its begin; while it is away two segments come and the oldest two
    go. Then one partition's position is no longer retained, one's is, one has none."""
    spark = log.spark
    path, out, mark = (new_table_path(spark, n) for n in ("topic", "read", "mark"))
    events = log.table("events")
    whole = events.agg(F.max("event_id") + 1).first()[0]

    def append(part: int):
        mine = F.floor(F.col("event_id") * 4 / F.lit(whole)) == part
        return topic.append_messages(events.filter(mine).select(
            (F.col("event_id") % 3).cast("int").alias("partition_id"), "event_id",
            F.lit(None).alias("key"), F.col("event_id").alias("value")), path, "event_id", WIDTH)

    def read(stream, run: int) -> None:
        stream.select(F.lit(run).alias("run"), "partition_id", "offset", "value").writeStream.format(
            "parquet").option("path", f"{out}/{run}").option("checkpointLocation", f"{mark}/{run}").trigger(
            availableNow=True).start().awaitTermination()

    append(0)
    read(topic.stream_topic(spark, path, starting="earliest"), 1)
    seen = topic.next_offsets(spark.read.parquet(f"{out}/1"))
    append(1)
    inside = written(topic.retained(spark, path), "ranges").filter("partition_id = 1").select(
        "partition_id", (F.col("next_offset") + 5).alias("offset"))
    append(2)
    topic.remove_segments(spark, path, 2)
    stream = topic.stream_topic(spark, path, seen.filter("partition_id = 0").unionByName(inside))
    append(3)
    read(stream, 2)
    return spark.read.parquet(f"{out}/1").unionByName(spark.read.parquet(f"{out}/2"))


@register("publish_at_least_once", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def publish_at_least_once(log: Log):
    spark = log.spark
    source, out, state, mark = (
        new_table_path(spark, n) for n in ("entries", "sent", "confirmed", "mark"))
    log.numbered.write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def sink(batch, epoch: int) -> None:
        batch.select("server_id", "seq", "batch_id", "in_id").write.mode("append").parquet(out)

    live.publish_at_least_once(stream, sink, state, mark, availableNow=True).awaitTermination()
    return spark.read.parquet(out)


# --- Whole plans -------------------------------------------------------------

_VALUE_SQL = """
, full_value as (select n.server_id, n.seq, n.batch_id, n.in_id, cast(to_json({'server_id': n.server_id, 'seq': n.seq,
 'type_code': n.type_code, 'logfile': n.logfile, 'logfile_offset': n.logfile_offset, 'execute_time': n.execute_time,
 'event_length': n.event_length, 'db': n.db, 'tbl': n.tbl, 'event_type': n.event_type, 'entry_type': n.entry_type,
 'is_ddl': n.is_ddl, 'transaction_id': n.transaction_id, 'thread_id': n.thread_id, 'sql': n.sql, 'batch_id': n.batch_id,
 'in_id': n.in_id, 'row_datas': x.row_datas}) as varchar) as value from numbered n left join nested x using (server_id, seq))"""
TRACK_BYTES = 100_000


@register("track_changes", sql(
    ROWS_JSON + _VALUE_SQL + _packed_sql(
        "full_value", "strlen(value)", "server_id, seq, batch_id, in_id, value", TRACK_BYTES) +
    """select server_id, seq, 'changes' topic, batch_id, in_id, message_no, md5(value) value_md5 from packed""",
    "numbered", "flagged"))
def track_changes(log: Log):
    messages, _, _ = H.track_changes(
        log.raw, log.cells, log.meta_now, ALLOW, max_bytes=TRACK_BYTES, max_rows=MAX_ROWS, width=WIDTH)
    return messages.select(
        "server_id", "seq", "topic", "batch_id", "in_id", "message_no", F.md5("value").alias("value_md5"))


@register("track_changes_checkpoint", sql(_CHECKPOINT_CTE + "select * from ck", "entries", "numbered"))
def track_changes_checkpoint(log: Log):
    _, checkpoint, _ = H.track_changes(
        log.raw, log.cells, log.meta_now, ALLOW, max_bytes=TRACK_BYTES, max_rows=MAX_ROWS, width=WIDTH,
        skip_errors=True)
    return checkpoint


# Metadata as it may be: none for one listed table, a column short for the other.
_REJECTED_SQL = """
, rej as (select server_id, seq, logfile, log_pos - event_len logfile_offset, table_error reason from resolved
 where table_error is not null
 union all select server_id, seq, logfile, log_pos - event_len, 'no table name found' from stmts where ddl and tbl is null
 union all select server_id, seq, logfile, log_pos - event_len, 'no original table found' from stmts
 where kind = 'RENAME' and tbl is not null and old_tbl is null
 union all select server_id, seq, logfile, log_pos - event_len, case tbl when 't_click' then 'no metadata for table:crm.t_click'
  else 'column size is not match for table:shop.t_user,6 vs 5' end from rows_ok
 where db || '.' || tbl in ('shop.t_user', 'crm.t_click'))"""


def _poor_meta(log: Log):
    return log.meta_now.filter((F.col("tbl") != "t_click") & ~(
        (F.col("tbl") == "t_user") & (F.col("ordinal") == 5)))


@register("track_changes_rejected", sql(
    _REJECTED_SQL + " select * from rej", "resolved", "stmts", "rows_ok"))
def track_changes_rejected(log: Log):
    return H.track_changes(log.raw, log.cells, _poor_meta(log), ALLOW, width=WIDTH)[2]


@register("track_changes_held", sql("""
, f as (select server_id, min(seq) first from (select server_id, seq from resolved where table_error is not null
  union all select server_id, seq from stmts where ddl and tbl is null
  union all select server_id, seq from stmts where kind = 'RENAME' and old_tbl is null) group by 1),
e as (select e.* from entries e left join f using (server_id) where first is null or seq < first),
n as (select n.* from numbered n left join f using (server_id) where first is null or seq < first),
c as (select server_id, max(seq) seq, arg_max(logfile, seq) logfile, arg_max(logfile_offset + event_length, seq) pos
 from e where entry_type = 'TRANSACTIONEND' group by 1),
i as (select server_id, coalesce(arg_max(case when is_end then batch_id + 1 else batch_id end, n.seq)
  filter (n.seq <= c.seq), 0) batch_id, coalesce(arg_max(case when is_end then 0 else in_id + 1 end, n.seq)
  filter (n.seq <= c.seq), 0) in_id from n join c using (server_id) group by 1)
select server_id, logfile, pos, batch_id, in_id, logfile || ':' || pos || ':' || batch_id || ':' || in_id as value
from c join i using (server_id)""", "resolved", "stmts", "entries", "numbered"))
def track_changes_held(log: Log):
    return H.track_changes(log.raw, log.cells, log.meta_now, ALLOW, width=WIDTH)[1]


@register("track_changes_resumed", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def track_changes_resumed(log: Log):
    """One run to a commit in the middle, another from its checkpoint; what came twice is dropped."""
    events = log.raw.agg(F.max("seq")).first()[0] // 10 + 1
    middle = (events // 10 * 5 + 4) * 10 + 5
    first, at, _ = H.track_changes(
        log.raw.filter(F.col("seq") <= middle), log.cells, log.meta_now, ALLOW, width=WIDTH,
        skip_errors=True)
    at = written(at, "checkpoint")
    second, _, _ = H.track_changes(
        log.raw, log.cells, log.meta_now, ALLOW, width=WIDTH, skip_errors=True, checkpoints=at)
    columns = ["server_id", "seq", "batch_id", "in_id"]
    seen = first.groupBy("server_id").agg(
        F.max(F.struct("batch_id", "in_id")).alias("m")).select("server_id", "m.*")
    return first.select(columns).unionByName(P.dedup_replayed(second.select(columns), seen))


def _resumed(log: Log, upto: int, skip_errors: bool):
    """A run over the log up to an event, then one over the whole log from its checkpoint; what the
    reader has by id is dropped."""
    first, at, _ = H.track_changes(
        log.raw.filter(F.col("seq") <= upto), log.cells, log.meta_now, ALLOW, width=WIDTH,
        skip_errors=skip_errors)
    second, _, _ = H.track_changes(
        log.raw, log.cells, log.meta_now, ALLOW, width=WIDTH, skip_errors=True,
        checkpoints=written(at, "checkpoint"))
    columns = ["server_id", "seq", "batch_id", "in_id"]
    seen = first.groupBy("server_id").agg(
        F.max(F.struct("batch_id", "in_id")).alias("m")).select("server_id", "m.*")
    return first.select(columns).unionByName(P.dedup_replayed(second.select(columns), seen))


@register("track_changes_resumed_inside", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def track_changes_resumed_inside(log: Log):
    """The log ends inside a transaction; its entries are sent again under the ids they had."""
    events = log.raw.agg(F.max("seq")).first()[0] // 10 + 1
    return _resumed(log, (events // 10 * 5 + 2) * 10 + 3, True)


@register("track_changes_resumed_held", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def track_changes_resumed_held(log: Log):
    """The checkpoint is held before the first rejected event, wherever its transaction is."""
    return _resumed(log, log.raw.agg(F.max("seq")).first()[0], False)


@register("track_changes_pruned", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def track_changes_pruned(log: Log):
    """Three runs over a stored log; the later ones read only files from their checkpoint on, with the
    context that was taken beside it."""
    spark = log.spark
    path = new_table_path(log.spark, "log")
    resume.store_log(log.raw, path, WIDTH)
    events = log.raw.agg(F.max("seq")).first()[0] // 10 + 1
    sent, at, seed = None, None, None
    columns = ["server_id", "seq", "batch_id", "in_id"]
    for upto in ((events // 15 * 5 + 2) * 10 + 3, (events // 15 * 10 + 3) * 10 + 3, events * 10):
        read = resume.read_from(spark, path, at).filter(F.col("seq") <= upto)
        messages, now, _ = H.track_changes(
            read.drop("logfile"), log.cells, log.meta_now, ALLOW, width=WIDTH, skip_errors=True,
            checkpoints=at, seed=seed)
        mine = written(messages.select(columns), "sent")
        if sent is not None:
            seen = sent.groupBy("server_id").agg(
                F.max(F.struct("batch_id", "in_id")).alias("m")).select("server_id", "m.*")
            mine = sent.unionByName(P.dedup_replayed(mine, seen))
        sent = written(mine, "sent")
        now = written(now, "checkpoint")
        seed = written(resume.context_at(read, now, seed), "context")
        at = now
    return sent


# Two listed tables in versions: t_user's second names a column anew and its third is a column
# short, t_click's first is a column short.
_VERSION_SQL = """
, ch as (select server_id, db, tbl, seq from good_stmts where kind in ('ALTER', 'ERASE', 'RENAME') and changed),
r as (select server_id, seq, db, tbl, (select count(*) from ch where ch.server_id = o.server_id and ch.db = o.db
  and ch.tbl = o.tbl and ch.seq < o.seq) n from rows_ok o where db || '.' || tbl in ('shop.t_user', 'crm.t_click'))
select server_id, seq, case when tbl = 't_click' then 'kind_2' when n = 0 then 'kind' when n = 1 then 'kind_2' end as name,
 case when tbl = 't_user' and n > 1 then 'column size is not match for table:shop.t_user,6 vs 5' end reason from r"""


def _versioned_meta(log: Log):
    renamed = F.when(F.col("ordinal") == 1, "kind_2").otherwise(F.col("name"))
    short = F.col("ordinal") < 5
    base = log.meta_now.drop("version")
    user, click = base.filter("tbl = 't_user'"), base.filter("tbl = 't_click'")
    parts = [(user, 1), (user.withColumn("name", renamed), 2), (user.filter(short), 3),
             (click.filter(short), 1), (click.withColumn("name", renamed), 2)]
    out = None
    for part, version in parts:
        part = part.withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part)
    return out


@register("track_changes_versions", sql(_VERSION_SQL, "good_stmts", "rows_ok"))
def track_changes_versions(log: Log):
    """The name of each rows event's second column under the metadata in force at the event, or why
    it has none."""
    messages, _, rejected = H.track_changes(
        log.raw, log.cells, _versioned_meta(log), ALLOW, width=WIDTH)
    named = [F.get_json_object("value", f"$.row_datas[0].{side}[1].name") for side in ("after", "before")]
    none = F.lit(None).cast("string")
    sent = messages.select("server_id", "seq", F.coalesce(*named).alias("name"), none.alias("reason"))
    lost = rejected.filter("reason like 'column size%'").select(
        "server_id", "seq", none.alias("name"), "reason")
    return sent.filter("name is not null").unionByName(lost)


@register("track_changes_listed_only", sql("""
, k as (select *, entry_type = 'TRANSACTIONEND' or is_ddl e from entries where db || '.' || tbl in ('shop.t_user', 'crm.t_click')),
b as (select *, coalesce(sum(e::int) over (partition by server_id order by seq rows between unbounded preceding
  and 1 preceding), 0)::bigint batch_id from k)
select server_id, seq, event_type, batch_id, row_number() over (partition by server_id, batch_id order by seq) - 1 in_id
from b""", "entries"))
def track_changes_listed_only(log: Log):
    return H.kept_entries(log.raw, ALLOW, markers="drop", width=WIDTH).select(
        "server_id", "seq", "event_type", "batch_id", "in_id")


@register("track_rows", sql("""
, k as (select *, entry_type = 'TRANSACTIONEND' e from entries where entry_type = 'TRANSACTIONEND'
 or (type_code in (23,24,25,30,31,32) and db || '.' || tbl in ('shop.t_user', 'crm.t_click'))),
b as (select *, coalesce(sum(e::int) over (partition by server_id order by seq rows between unbounded preceding
  and 1 preceding), 0)::bigint batch_id from k)
select server_id, seq, logfile, logfile_offset, db, tbl, event_type, batch_id,
 row_number() over (partition by server_id, batch_id order by seq) - 1 in_id from b""", "entries"))
def track_rows(log: Log):
    return H.track_rows(log.raw, ALLOW, WIDTH).select(
        "server_id", "seq", "logfile", "logfile_offset", "db", "tbl", "event_type", "batch_id", "in_id")


@register("track_changes_stream", sql(
    ROWS_JSON + _VALUE_SQL + "select server_id, seq, batch_id, in_id, md5(value) value_md5 from full_value",
    "numbered", "flagged"))
def track_changes_stream(log: Log):
    """The log arrives in four parts; context is carried from each run to the next."""
    sink, _ = _streamed(log, log.meta_now, 4)
    return sink.select("server_id", "seq", "batch_id", "in_id", F.md5("value").alias("value_md5"))


def _streamed(log: Log, meta, parts: int, **options):
    """What a stream sends and rejects when the log arrives in parts, each in a run of its own."""
    spark = log.spark
    source, state, sink, mark = (
        new_table_path(spark, n) for n in ("live", "state", "sink", "mark"))
    images = F.sort_array(F.collect_list(F.struct(*live.IMAGES.elementType.names))).alias("images")
    whole = merged(log.raw, log.cells.groupBy("server_id", "seq").agg(images), ["server_id", "seq"], "left")
    events = written(whole, "events")
    last = events.agg(F.max("seq")).first()[0]
    for part in range(parts):
        low, high = (last + 1) * part // parts, (last + 1) * (part + 1) // parts
        arrived = events.filter((F.col("seq") >= low) & (F.col("seq") < high))
        arrived.write.mode("append").parquet(source)
        stream = live.stream_change_log(spark, "parquet", {"path": source}, live.LIVE_EVENT)
        live.track_changes_stream(
            stream, meta, ALLOW, state, sink, mark, trigger={"availableNow": True},
            width=WIDTH, **options).awaitTermination()
    return spark.read.parquet(sink), spark.read.parquet(sink + "-rejected")


@register("track_changes_stream_packed", sql(
    ROWS_JSON + _VALUE_SQL + _packed_sql(
        "full_value", "strlen(value)", "server_id, seq, batch_id, in_id, value", TRACK_BYTES) +
    "select server_id, seq, batch_id, in_id, message_no from packed", "numbered", "flagged"))
def track_changes_stream_packed(log: Log):
    """Messages left open by one micro-batch go on in the next, as if the log had come at once."""
    sink, _ = _streamed(log, log.meta_now, 3, max_bytes=TRACK_BYTES, max_rows=MAX_ROWS)
    return sink.select("server_id", "seq", "batch_id", "in_id", "message_no")


@register("track_changes_stream_versions", sql(_VERSION_SQL, "good_stmts", "rows_ok"))
def track_changes_stream_versions(log: Log):
    """As track_changes_versions, with the changes of earlier micro-batches carried along."""
    messages, rejected = _streamed(log, _versioned_meta(log), 3)
    named = [F.get_json_object("value", f"$.row_datas[0].{side}[1].name") for side in ("after", "before")]
    none = F.lit(None).cast("string")
    sent = messages.select("server_id", "seq", F.coalesce(*named).alias("name"), none.alias("reason"))
    lost = rejected.filter("reason like 'column size%'").select(
        "server_id", "seq", none.alias("name"), "reason")
    return sent.filter("name is not null").unionByName(lost)


@register("track_changes_stream_started", sql(
    "select server_id, seq, batch_id, in_id from numbered", "numbered"))
def track_changes_stream_started(log: Log):
    """A batch run up to the middle of a transaction, then a stream over the whole log that starts
    at its checkpoint, which the retained log files confirm."""
    events = log.raw.agg(F.max("seq")).first()[0] // 10 + 1
    first, at, _ = H.track_changes(
        log.raw.filter(F.col("seq") <= (events // 10 * 5 + 2) * 10 + 3), log.cells, log.meta_now,
        ALLOW, width=WIDTH, skip_errors=True)
    second, _ = _streamed(log, log.meta_now, 2, checkpoints=written(at, "checkpoint"),
                          log_index=log.log_index, master=log.master)
    columns = ["server_id", "seq", "batch_id", "in_id"]
    seen = first.groupBy("server_id").agg(
        F.max(F.struct("batch_id", "in_id")).alias("m")).select("server_id", "m.*")
    return first.select(columns).unionByName(P.dedup_replayed(second.select(columns), seen))


_STORE_KEEP = r"regexp_full_match(db || '.' || tbl, 'shop\..*|crm\.t_c.*')"


@register("track_to_store", sql(ROWS_JSON + f"""
select e.server_id, e.seq, e.event_type, 99 + row_number() over (partition by e.server_id order by e.seq) row_key,
 md5(cast(to_json(x.row_datas) as varchar)) body_md5
from entries e left join nested x using (server_id, seq) where {_STORE_KEEP}""", "entries", "flagged"))
def track_to_store(log: Log):
    rows, _, _ = H.track_to_store(
        log.raw, log.cells, log.meta_now, r"shop\..*,crm\.t_c.*", 100, WIDTH)
    body = F.md5(F.to_json("row_datas", {"ignoreNullFields": "false"}))
    return rows.select("server_id", "seq", "event_type", "row_key", body.alias("body_md5"))


@register("track_to_store_checkpoint", sql(f"""
, k as (select *, 99 + row_number() over (partition by server_id order by seq) row_key from entries where {_STORE_KEEP})
select server_id, arg_max(logfile || ':' || (logfile_offset + event_length), row_key) binlog_xid,
 cast(max(row_key) + 1 as varchar) event_row_key from k where type_code = 2 group by 1""", "entries"))
def track_to_store_checkpoint(log: Log):
    _, ckpt, _ = H.track_to_store(
        log.raw, log.cells, log.meta_now, r"shop\..*,crm\.t_c.*", 100, WIDTH, skip_errors=True)
    return ckpt


@register("track_to_store_rejected", sql(
    _REJECTED_SQL + " select * from rej", "resolved", "stmts", "rows_ok"))
def track_to_store_rejected(log: Log):
    return H.track_to_store(
        log.raw, log.cells, _poor_meta(log), r"shop\.t_user,crm\.t_click", 0, WIDTH)[2]


@register("simple_track", sql("""
select server_id, seq, row_idx, ordinal, event_type, execute_time, db || '.' || tbl dbtb,
 logfile || '#' || logfile_offset as position, name, value
from rendered r join (select server_id, seq, execute_time from hdr) h using (server_id, seq)
where image = case when event_type = 'DELETE' then 'B' else 'A' end and db || '.' || tbl in ('shop.t_user', 'crm.t_click')""",
    "rendered", "hdr"))
def simple_track(log: Log):
    return H.simple_track(log.raw, log.cells, log.meta_now, ALLOW, WIDTH)[0]


@register("simple_track_rejected", sql("""
select server_id, seq, logfile, log_pos - event_len logfile_offset, table_error reason from resolved
where table_error is not null""", "resolved"))
def simple_track_rejected(log: Log):
    return H.simple_track(log.raw, log.cells, log.meta_now, ALLOW, WIDTH)[1]

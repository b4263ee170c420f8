"""DuckDB building blocks: the change log and each step of the pipeline as plain SQL.

These are the specification the Spark operators are compared with, so they use the
simple form of every rule (one window per server, no ranges, no carried totals).
"""

from __future__ import annotations

from registry.sample_log import META_COLUMNS, STATEMENTS, TABLES


def _text(value: str) -> str:
    quoted = "'" + value.replace("'", "''") + "'"
    return quoted.replace("\n", "' || chr(10) || '")


_STATEMENT = " ".join(f"when {i} then {_text(s)}" for i, s in enumerate(STATEMENTS))
_META = ",\n".join(
    f"('{db}','{tbl}',{v},{i},'{name}','{kind}','{'NO' if key else 'YES'}','{key}')"
    for db, tbl in TABLES
    for v, width in (((1, 5), (2, 6)) if tbl == "t_misc" else ((1, 6),))
    for i, (name, kind, key) in enumerate(META_COLUMNS[:width])
)
_DB = " ".join(f"when {i} then '{d}'" for i, (d, _) in enumerate(TABLES))
_TBL = " ".join(f"when {i} then '{t}'" for i, (_, t) in enumerate(TABLES))

# name -> (names it needs, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
select *, event_id // 500 f, event_id % 500 r, (event_id // 40) % 7 sub,
 case when (event_id // 500) % 3 = 2 then 2 else 1 end server_id,
 (user_id + case when event_id % 7 = 3 then 1 else 0 end) % 4 mapped from events"""),
    "slots": (("ev",), """
select *, 0 k from ev where r = 0 and f > 0
union all select *, 1 from ev where event_id % 5 = 0
union all select *, 2 from ev union all select *, 3 from ev
union all select *, 4 from ev where event_id % 50 = 7
union all select *, 5 from ev where event_id % 5 = 4
union all select *, 6 from ev where event_id % 40 = 11
union all select *, 7 from ev where event_id % 100 = 50"""),
    "raw": (("slots",), f"""
select server_id, event_id * 10 + k seq,
 case k when 0 then 4 when 1 then 2 when 2 then 19 when 4 then 2 when 5 then 16
  when 3 then case event_type when 'signup' then 30 when 'view' then 23 when 'purchase' then 31
                              when 'click' then 24 else 32 end
  when 6 then case sub when 0 then 29 when 1 then 160 when 2 then 5 when 3 then 13 else 14 end
  else case (event_id // 100) % 4 when 0 then 15 when 1 then 27 when 2 then 33 else 3 end end type_code,
 100 + event_id % 37 * 3 event_len, 4 + (r * 10 + k) * 200 + 100 + event_id % 37 * 3 log_pos,
 case when k = 3 and event_id % 20 = 19 then 1 else 0 end flags,
 case when k = 0 then 'mysql-bin.' || lpad(cast(f + 1 as varchar), 6, '0') end rotate_file,
 case when k = 2 then 100 + mapped
      when k = 3 then case when event_id % 101 = 7 then 999 else 100 + user_id % 4 end end table_id,
 case when k = 2 then case mapped {_DB} end end map_db,
 case when k = 2 then case mapped {_TBL} end end map_tbl,
 case when k = 1 then 'BEGIN' when k = 4 then case (event_id // 50) % {len(STATEMENTS)} {_STATEMENT} end
      when k = 6 and sub < 2 then 'insert into t_order values (' || event_id || ')' end query,
 case when k in (1, 4) then event_id % 1000 + 1 end session_id,
 case when k in (1, 4) then case when event_id % 3 = 0 then '' else 'shop' end end session_db,
 case when k = 5 then event_id * 7 end xid,
 case when k = 6 and sub >= 4 then 'v' || event_id % 9 end var_name,
 case when k = 6 and sub >= 4 then case when sub = 6 then 1 else 0 end end var_type,
 case when k = 6 and sub = 5 then 'it' when k = 6 and sub = 6 then (event_id % 10) || '.5' end var_text,
 case when k = 6 and sub in (2, 3) then event_id * 3 end num1,
 case when k = 6 and sub = 3 then event_id * 5 end num2, ts from slots"""),
    "cells": (("ev",), """
select server_id, event_id * 10 + 3 seq, cast(row_idx as int) row_idx, image, cast(ordinal as int) ordinal,
 case ordinal when 0 then 8 when 1 then 15 when 2 then 246 when 3 then 1 when 4 then 252 else 12 end mysql_type,
 case ordinal when 1 then 48 when 2 then 2562 when 4 then 2 else 0 end meta,
 case ordinal when 0 then 8 when 3 then 1 when 5 then 8 else 0 end byte_len,
 case ordinal when 0 then case when event_id % 13 = 0 then -1 - user_id else user_id end
  when 3 then (event_id * 7 + row_idx + case when image = 'A' then 13 * (event_id % 2) else 0 end) % 256 - 128
  when 5 then case when event_id % 97 = 0 then 0 else cast(strftime(ts, '%Y%m%d%H%M%S') as bigint) end end raw_long,
 case ordinal when 1 then case when event_id % 11 = 0 and image = 'B' then null else event_type end
  when 2 then cast(cast(value + case when image = 'A' then row_idx else 0 end as decimal(10,2)) as varchar)
  when 4 then props end raw_str,
 case when event_type in ('signup','view') then 'INSERT' when event_type in ('purchase','click') then 'UPDATE'
      else 'DELETE' end kind
from ev, range(3) a(row_idx), (values ('B'), ('A')) b(image), range(6) c(ordinal)
where row_idx <= event_id % 3 and ((image = 'A' and event_type in ('signup','view','purchase','click'))
  or (image = 'B' and event_type not in ('signup','view')))"""),
    "meta": ((), f"""
select * from (values {_META}) m(db, tbl, version, ordinal, name, column_type, nullable, column_key)"""),
    "meta_now": (("meta",), """
select *, upper(column_key) = 'PRI' is_key, contains(column_type, 'unsigned') is_unsigned
from meta m where version = (select max(version) from meta n where n.db = m.db and n.tbl = m.tbl)"""),
    "logfiles": (("raw",), """
select *, coalesce(last_value(rotate_file ignore nulls) over (partition by server_id order by seq),
 'mysql-bin.000001') logfile,
 max(case when type_code in (23,24,25,30,31,32) and flags & 1 = 1 then seq end)
  over (partition by server_id order by seq rows between unbounded preceding and 1 preceding) closed
from raw"""),
    "resolved": (("logfiles",), """
select * exclude (m), m.db db, m.tbl tbl, case when m is null and type_code <> 19 then
 'not found tableId:' || table_id end table_error from (
 select * exclude (lm), case when lm.at > coalesce(closed, -1) then lm end m from (
  select *, last_value(case when type_code = 19 then {'at': seq, 'db': map_db, 'tbl': map_tbl} end ignore nulls)
   over (partition by server_id, table_id order by seq) lm
  from logfiles where type_code in (19,23,24,25,30,31,32))) where type_code <> 19"""),
    "rows_ok": (("resolved",), """
select *, case when type_code in (23,30) then 'INSERT' when type_code in (24,31) then 'UPDATE' else 'DELETE' end kind
from resolved where table_error is null"""),
    # --- Fixed values: the statement patterns, as in tidelog/functions/text.py ---
    "stmt1": (("logfiles",), r"""
select *, regexp_replace(query, '/\*(?:/|.*?\*/)', ' ', 'gs') clean from logfiles
where type_code = 2 and not (upper(query) like '%BEGIN' or upper(query) like '%COMMIT')"""),
    "stmt2": (("stmt1",), r"""
select *, case
 when regexp_full_match(clean, '\s*ALTER\s*(IGNORE)?\s*TABLE\s*(.*)', 'is') then 'ALTER'
 when regexp_full_match(clean, '\s*CREATE\s*(TEMPORARY)?\s*TABLE\s*(.*)', 'is') then 'CREATE'
 when regexp_full_match(clean, '\s*DROP\s*(TEMPORARY)?\s*TABLE\s*(.*)', 'is') then 'ERASE'
 when regexp_full_match(clean, '\s*TRUNCATE\s*(TABLE)?\s*(.*)', 'is') then 'TRUNCATE'
 when regexp_full_match(clean, '\s*RENAME\s*TABLE\s*(.*?)\s*TO\s*(.*?)', 'is') then 'RENAME'
 when regexp_full_match(clean, '\s*CREATE\s*.*?\s*INDEX\s*(.*?)\s*ON\s*(.*?)', 'is') then 'CINDEX'
 when regexp_full_match(clean, '\s*DROP\s*INDEX\s*(.*?)\s*ON\s*(.*?)', 'is') then 'DINDEX'
 when regexp_full_match(clean, '\s*(INSERT|MERGE|REPLACE)(.*)', 'is') then 'INSERT'
 when regexp_full_match(clean, '\s*UPDATE(.*)', 'is') then 'UPDATE'
 when regexp_full_match(clean, '\s*DELETE(.*)', 'is') then 'DELETE' else 'QUERY' end kind from stmt1"""),
    "stmt3": (("stmt2",), r"""
select *, case kind
 when 'ALTER' then regexp_extract(clean, '^\s*ALTER\s*(IGNORE)?\s*TABLE\s*(.*)$', 2, 'is')
 when 'CREATE' then regexp_extract(clean, '^\s*CREATE\s*(TEMPORARY)?\s*TABLE\s*(.*)$', 2, 'is')
 when 'ERASE' then regexp_extract(clean, '^\s*DROP\s*(TEMPORARY)?\s*TABLE\s*(.*)$', 2, 'is')
 when 'TRUNCATE' then regexp_extract(clean, '^\s*TRUNCATE\s*(TABLE)?\s*(.*)$', 2, 'is')
 when 'RENAME' then regexp_extract(clean, '^\s*RENAME\s*TABLE\s*(.*?)\s*TO\s*(.*?)$', 2, 'is')
 when 'CINDEX' then regexp_extract(clean, '^\s*CREATE\s*.*?\s*INDEX\s*(.*?)\s*ON\s*(.*?)$', 2, 'is')
 when 'DINDEX' then regexp_extract(clean, '^\s*DROP\s*INDEX\s*(.*?)\s*ON\s*(.*?)$', 2, 'is') end t_text,
 case kind when 'RENAME' then regexp_extract(clean, '^\s*RENAME\s*TABLE\s*(.*?)\s*TO\s*(.*?)$', 1, 'is') end o_text
from stmt2"""),
    # --- End of fixed values ----------------------------------------------------
    "stmt4": (("stmt3",), r"""
select *, string_split(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(
  regexp_extract(t_text || ' ', '^(?:IF\s*NOT\s*EXISTS\s*)?(?:IF\s*EXISTS\s*)?(.+?[;(\s])', 1, 'is'), ';$', ''), '\($', ''), ' ' || chr(9) || chr(10) || chr(13)),
  '`$', ''), '^`', ''), '.') tp,
 string_split(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(
  regexp_extract(o_text || ' ', '^(?:IF\s*NOT\s*EXISTS\s*)?(?:IF\s*EXISTS\s*)?(.+?[;(\s])', 1, 'is'), ';$', ''), '\($', ''), ' ' || chr(9) || chr(10) || chr(13)),
  '`$', ''), '^`', ''), '.') op from stmt3"""),
    "stmts": (("stmt4",), r"""
select * exclude (tp, op, t_text, o_text), kind in ('ALTER','CREATE','ERASE','TRUNCATE','RENAME','CINDEX','DINDEX') ddl,
 kind in ('INSERT','UPDATE','DELETE') dml,
 case when len(tp) > 1 then regexp_replace(regexp_replace(tp[1], '`$', ''), '^`', '') else session_db end db,
 case when len(tp) > 1 then regexp_replace(regexp_replace(tp[2], '`$', ''), '^`', '') else nullif(tp[1], '') end tbl,
 case when kind = 'ALTER' then regexp_matches(regexp_replace(regexp_replace(regexp_replace(clean, '''[^'']*''', '''''', 'g'),
   '`[^`]*`', '`', 'g'), '\b(ADD|DROP|RENAME)\s+(INDEX|KEY|CONSTRAINT|PRIMARY|UNIQUE|FULLTEXT|SPATIAL|FOREIGN|PARTITION|CHECK)\b', ' ', 'gi'),
   '\b(ADD|DROP|CHANGE|MODIFY)[\s`(]|\bRENAME\s+COLUMN\b', 'i') else kind in ('ERASE', 'RENAME') end changed,
 case when kind = 'RENAME' then nullif(case when len(op) > 1 then regexp_replace(regexp_replace(op[1], '`$', ''), '^`', '')
   else session_db end, '') end old_db,
 case when kind = 'RENAME' then case when len(op) > 1 then regexp_replace(regexp_replace(op[2], '`$', ''), '^`', '')
   else nullif(op[1], '') end end old_tbl from stmt4"""),
    "good_stmts": (("stmts",), "select * from stmts where not ddl or tbl is not null"),
    "hdr": (("logfiles",), """
select server_id, seq, type_code, logfile, log_pos - event_len logfile_offset,
 cast(epoch(date_trunc('second', ts)) as bigint) * 1000 execute_time, event_len event_length, ts from logfiles"""),
    "body": (("rows_ok", "good_stmts", "logfiles"), """
select server_id, seq, db, tbl, kind event_type, 'ROWDATA' entry_type, false is_ddl,
 null::varchar transaction_id, null::bigint thread_id, null::varchar sql from rows_ok
union all select server_id, seq, db, coalesce(tbl, ''), case when ddl then kind else 'QUERY' end, 'ROWDATA',
 kind <> 'QUERY', null, null, query from good_stmts
union all select server_id, seq, '', '', null, 'TRANSACTIONBEGIN', false, null, session_id, null
 from logfiles where type_code = 2 and upper(query) like '%BEGIN'
union all select server_id, seq, '', '', null, 'TRANSACTIONEND', false,
 case when type_code = 16 then cast(xid as varchar) else '0' end, null, null
 from logfiles where type_code = 16 or (type_code = 2 and upper(query) like '%COMMIT')
union all select server_id, seq, '', '', 'QUERY', 'ROWDATA', false, null, null,
 case when type_code in (29, 160) then query when type_code = 5 then 'SET INSERT_ID = ' || num1
  when type_code = 13 then 'SET SESSION rand_seed1 = ' || num1 || ' , rand_seed2 = ' || num2
  when var_text is null then 'SET @' || var_name || ' := NULL'
  when var_type = 0 then 'SET @' || var_name || ' := ''' || var_text || ''''
  else 'SET @' || var_name || ' := ' || var_text end
 from logfiles where type_code in (29, 160, 5, 13, 14)"""),
    "entries": (("hdr", "body"), "select h.*, b.* exclude (server_id, seq) from hdr h join body b using (server_id, seq)"),
    # Kept: listed tables plus every marker.
    "kept": (("entries",), """
select * from entries where entry_type <> 'ROWDATA' or db || '.' || tbl in ('shop.t_user', 'crm.t_click')"""),
    "ended": (("kept",), """
select *, entry_type = 'TRANSACTIONEND' or is_ddl is_end from kept"""),
    "batched": (("ended",), """
select *, coalesce(sum(is_end::int) over (partition by server_id order by seq
  rows between unbounded preceding and 1 preceding), 0)::bigint batch_id from ended"""),
    "numbered": (("batched",), """
select *, row_number() over (partition by server_id, batch_id order by seq) - 1 in_id from batched"""),
    "owned": (("cells", "rows_ok"), """
select c.*, o.db, o.tbl, o.kind event_type, o.logfile, o.log_pos - o.event_len logfile_offset
from cells c join rows_ok o using (server_id, seq)"""),
    "enriched": (("owned", "meta_now"), """
select o.*, m.name, m.is_key, m.column_type, m.is_unsigned from owned o join meta_now m using (db, tbl, ordinal)"""),
    "rendered": (("enriched",), """
select *, case ordinal
  when 0 then cast(case when raw_long < 0 then raw_long::hugeint + 18446744073709551616 else raw_long::hugeint end as varchar)
  when 3 then cast(case when raw_long < 0 then raw_long + 256 else raw_long end as varchar)
  when 5 then case when raw_long = 0 then '0000-00-00 00:00:00'
    else strftime(strptime(cast(raw_long as varchar), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') end
  else raw_str end as value,
 case ordinal when 0 then case when raw_long < 0 then 3 else -5 end when 1 then 12 when 2 then 3
  when 3 then case when raw_long < 0 then 5 else -6 end
  when 4 then case when raw_str is null then -4 else 2005 end else 93 end sql_type
from enriched"""),
    "flagged": (("rendered",), """
select *, image = 'A' and bool_or(image = 'B') over w
 and value is distinct from max(value) filter (where image = 'B') over w updated
from rendered window w as (partition by server_id, seq, row_idx, ordinal)"""),
    "listed_numbered": (("entries",), """
select * from entries where db || '.' || tbl in ('shop.t_user', 'crm.t_click')"""),
    "invalidations": (("good_stmts",), """
select server_id, db, tbl, seq, row_number() over w n, lead(seq) over w nxt, changed,
 sum(changed::int) over w changes from good_stmts
where kind in ('ALTER', 'ERASE', 'RENAME') window w as (partition by server_id, db, tbl order by seq)"""),
    "versions": (("invalidations", "meta", "raw"), """
select v.*, least(v.changes + 1, x.mx)::int as version from (
 select server_id, db, tbl, null::bigint valid_from, min(seq) valid_to, 1 as interval, 0 changes from invalidations group by 1, 2, 3
 union all select server_id, db, tbl, seq, nxt, n + 1, changes from invalidations
 union all select distinct server_id, map_db, map_tbl, null::bigint, null::bigint, 1, 0 from raw r where type_code = 19
  and not exists (select 1 from invalidations i where i.server_id = r.server_id and i.db = r.map_db and i.tbl = r.map_tbl)) v
 join (select distinct server_id, map_db db, map_tbl tbl from raw where type_code = 19) seen using (server_id, db, tbl)
 join (select db, tbl, max(version) mx from meta group by 1, 2) x using (db, tbl)"""),
    "master": (("logfiles",), """
select server_id, arg_max(logfile, seq) logfile, arg_max(log_pos, seq) pos from logfiles group by 1"""),
    "log_index": (("logfiles",), """
select server_id, logfile, min(log_pos - event_len) first_pos, max(log_pos) last_pos from logfiles group by 1, 2"""),
}


def sql(body: str, *needs: str) -> str:
    """``body`` behind a WITH clause of everything it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in CTES[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    head = ",\n".join(f"{n} as ({CTES[n][1]})" for n in order)
    return f"with recursive {head}\n{body.lstrip()}" if order else body

"""Classification, context, statements and filters over the whole change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import ALLOW, WIDTH, Log, register
from registry.ctes import sql
from tidelog.functions import text as X
from tidelog.operators import columns as E
from tidelog.operators import context as C
from tidelog.operators import filters as D
from tidelog.operators import statements as T
from tidelog import schemas as S
from tidelog.sources.shared import written

_NAMES = " ".join(f"when {c} then '{n}'" for c, n in S.EVENT_NAMES.items())


@register("event_type_name", sql(
    f"select server_id, seq, case type_code {_NAMES} else 'Unknown' end type_name from raw", "raw"))
def event_type_name(log: Log):
    return C.event_type_name(log.raw).select("server_id", "seq", "type_name")


@register("select_events", sql(
    "select server_id, seq, type_code from raw where type_code >= 2 and type_code < 20", "raw"))
def select_events(log: Log):
    return C.select_events(log.raw, 2, 20).select("server_id", "seq", "type_code")


@register("convertible_events", sql(
    "select server_id, seq, type_code from raw where type_code not in (3, 4, 15, 19, 27, 33)", "raw"))
def convertible_events(log: Log):
    return C.convertible_events(log.raw).select("server_id", "seq", "type_code")


@register("attach_logfile", sql("select server_id, seq, logfile from logfiles", "logfiles"))
def attach_logfile(log: Log):
    return log.events.select("server_id", "seq", "logfile")


@register("resolve_table", sql(
    "select server_id, seq, table_id, db, tbl, table_error from resolved", "resolved"))
def resolve_table(log: Log):
    return C.resolve_table(log.raw, WIDTH).select(
        "server_id", "seq", "table_id", "db", "tbl", "table_error")


@register("row_event_kind", sql("""
select server_id, seq, case when type_code in (23,30) then 'INSERT' when type_code in (24,31) then 'UPDATE'
 when type_code in (25,32) then 'DELETE' end event_type,
 case when type_code not in (23,24,25,30,31,32) then 'unsupported event type: ' || type_code end kind_error
from raw""", "raw"))
def row_event_kind(log: Log):
    return C.row_event_kind(log.raw).select("server_id", "seq", "event_type", "kind_error")


@register("build_header", sql("""
select h.server_id, h.seq, 1::bigint as version, h.logfile, h.logfile_offset, 'UTF-8' server_encode,
 h.execute_time, 'MYSQL' source_type, coalesce(r.db, '') schema_name, coalesce(r.tbl, '') table_name,
 h.event_length, r.kind event_type
from hdr h left join (select server_id, seq, db, tbl, case when type_code in (23,30) then 'INSERT'
  when type_code in (24,31) then 'UPDATE' else 'DELETE' end kind from resolved) r using (server_id, seq)
where h.type_code in (16,23,24,25,30,31,32)""", "hdr", "resolved"))
def build_header(log: Log):
    events = C.resolved_events(log.raw, WIDTH).filter(
        (F.col("type_code") == S.XID) | C.is_rows_event())
    h = F.col("header")
    return C.build_header(events).select(
        "server_id", "seq", h["version"].cast("bigint").alias("version"),
        h["logfile_name"].alias("logfile"), h["logfile_offset"].alias("logfile_offset"),
        h["server_encode"].alias("server_encode"), h["execute_time"].alias("execute_time"),
        h["source_type"].alias("source_type"), h["schema_name"].alias("schema_name"),
        h["table_name"].alias("table_name"), h["event_length"].alias("event_length"),
        h["event_type"].alias("event_type"))


@register("transaction_markers", sql("""
select server_id, seq, logfile, logfile_offset, entry_type, cast(thread_id as varchar) thread_id, transaction_id
from entries where entry_type <> 'ROWDATA'""", "entries"))
def transaction_markers(log: Log):
    return C.transaction_markers(log.events).select(
        "server_id", "seq", "logfile", "logfile_offset", "entry_type",
        F.col("thread_id").cast("string").alias("thread_id"), "transaction_id")


@register("statement_entries", sql("""
select server_id, seq, event_type, sql from entries where type_code in (29, 160, 5, 13, 14)""", "entries"))
def statement_entries(log: Log):
    return C.statement_entries(log.events).select("server_id", "seq", "event_type", "sql")


@register("event_trace", sql(f"""
select server_id, seq, case type_code {_NAMES} else 'Unknown' end type_name, log_pos - event_len now_pos,
 log_pos next_pos, logfile, case when type_code = 2 then query end as sql from logfiles""", "logfiles"))
def event_trace(log: Log):
    return C.event_trace(log.events)


# --- Statement text: every query event and every document text ---------------

@register("strip_comments", sql(r"""
select seq as id, regexp_replace(query, '/\*(?:/|.*?\*/)', ' ', 'gs') clean from raw where type_code = 2
union all select -1 - doc_id, regexp_replace('/* ' || text || ' */' || text, '/\*(?:/|.*?\*/)', ' ', 'gs')
from documents""", "raw"))
def strip_comments(log: Log):
    wrapped = F.concat(F.lit("/* "), F.col("text"), F.lit(" */"), F.col("text"))
    texts = log.table("documents").select((-1 - F.col("doc_id")).alias("id"), wrapped.alias("q"))
    queries = log.raw.filter(F.col("type_code") == S.QUERY).select(
        F.col("seq").alias("id"), F.col("query").alias("q"))
    return queries.unionByName(texts).select("id", X.strip_comments(F.col("q")).alias("clean"))


@register("classify_statement", sql("select seq, kind from stmts", "stmts"))
def classify_statement(log: Log):
    found = log.raw.filter(T.is_statement())
    return found.select("seq", X.statement_kind(X.strip_comments(F.col("query"))).alias("kind"))


@register("statement_table", sql("select seq, db, tbl from stmts", "stmts"))
def statement_table(log: Log):
    found = log.raw.filter(T.is_statement())
    name = X.statement_table(X.strip_comments(F.col("query")), F.col("session_db"))
    return found.select("seq", name.alias("n")).select("seq", "n.db", "n.tbl")


@register("rename_endpoints", sql("""
select seq, case when kind = 'RENAME' then nullif(db, '') end db, case when kind = 'RENAME' then tbl end tbl,
 old_db, old_tbl from stmts""", "stmts"))
def rename_endpoints(log: Log):
    found = log.raw.filter(T.is_statement())
    ends = X.rename_endpoints(X.strip_comments(F.col("query")), F.col("session_db"))
    return found.select("seq", ends.alias("e")).select("seq", "e.*")


@register("ddl_entries", sql("""
select server_id, seq, logfile, log_pos - event_len logfile_offset, db, coalesce(tbl, '') tbl,
 case when ddl then kind else 'QUERY' end event_type, kind change_type, kind <> 'QUERY' is_ddl,
 nullif(session_db, '') ddl_schema, query as sql from good_stmts""", "good_stmts"))
def ddl_entries(log: Log):
    return T.ddl_entries(log.statements).select(
        "server_id", "seq", "logfile", "logfile_offset", "db", "tbl", "event_type", "change_type",
        "is_ddl", "ddl_schema", "sql")


@register("quarantine_ddl", sql("""
select server_id, seq, query, 'no table name found' error from stmts where ddl and tbl is null""", "stmts"))
def quarantine_ddl(log: Log):
    _, bad = T.quarantine_ddl(log.statements)
    return bad.select("server_id", "seq", "query", "error")


@register("filter_statement_class", sql("""
select 'ddl' kept, seq from stmts where ddl union all select 'dml', seq from stmts where dml
union all select 'other', seq from stmts where not ddl and not dml""", "stmts"))
def filter_statement_class(log: Log):
    s = log.statements
    only = {"ddl": (False, True, True), "dml": (True, False, True), "other": (True, True, False)}
    parts = [T.filter_statement_class(s, *flags).select(F.lit(name).alias("kept"), "seq")
             for name, flags in only.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _versions(log: Log):
    seen = log.raw.filter(F.col("type_code") == S.TABLE_MAP).select("server_id", "db", "tbl")
    return T.schema_versions(log.statements, log.meta, seen, WIDTH)


@register("schema_versions", sql("""
select v.server_id, v.db, v.tbl, cast(v.interval as bigint) as interval, cast(v.version as bigint) as version,
 v.valid_from, v.valid_to, cast(m.ordinal as bigint) ordinal, m.name, m.column_type
from versions v join meta m using (db, tbl, version)""", "versions"))
def schema_versions(log: Log):
    return _versions(log).select(
        "server_id", "db", "tbl", "interval", F.col("version").cast("bigint").alias("version"),
        "valid_from", "valid_to", F.col("ordinal").cast("bigint").alias("ordinal"), "name",
        "column_type")


@register("check_column_count", sql("""
, w as (select server_id, seq, db, tbl, max(ordinal) + 1 width from owned group by 1, 2, 3, 4),
mw as (select db, tbl, version, count(*) n from meta group by 1, 2, 3),
v as (select v.*, a.n meta_width, b.n next_width from versions v join mw a using (db, tbl, version)
 left join mw b on b.db = v.db and b.tbl = v.tbl and b.version = v.version + 1)
select w.server_id, w.seq, w.db, w.tbl, cast(w.width as bigint) width, cast(v.meta_width as bigint) meta_width,
 case when width <= meta_width then 'ok' when width <= coalesce(next_width, -1) then 'reloaded' else 'error' end as "check"
from w join v on v.server_id = w.server_id and v.db = w.db and v.tbl = w.tbl
 and w.seq > coalesce(v.valid_from, -1) and (v.valid_to is null or w.seq <= v.valid_to)
""", "owned", "versions", "meta"))
def check_column_count(log: Log):
    widths = E.event_widths(log.owned)
    # Few rows that several joins read.
    spans = written(E.version_widths(written(_versions(log), "versions"), log.meta), "spans")
    return E.check_column_count(widths, spans, WIDTH).select(
        "server_id", "seq", "db", "tbl", F.col("width").cast("bigint").alias("width"),
        F.col("meta_width").cast("bigint").alias("meta_width"), "check")


# --- Filters -----------------------------------------------------------------

@register("match_tables", sql(r"""
select server_id, seq, db, tbl from rows_ok
where regexp_full_match(db || '.' || tbl, 'shop\..*|crm\.t_c.*|CRM\.T_MISC')""", "rows_ok"))
def match_tables(log: Log):
    rows = log.resolved.filter(F.col("table_error").isNull())
    return D.match_tables(rows, r"shop\..*,crm\.t_c.*,CRM\.T_MISC").select(
        "server_id", "seq", "db", "tbl")


@register("match_tables_ci", sql(r"""
select server_id, seq, db, tbl from rows_ok
where regexp_full_match(lower(db || '.' || tbl), 'SHOP\.T_USER|crm\.t_m.*', 'i')""", "rows_ok"))
def match_tables_ci(log: Log):
    rows = log.resolved.filter(F.col("table_error").isNull())
    return D.match_tables_ci(rows, r"SHOP\.T_USER,crm\.t_m.*").select("server_id", "seq", "db", "tbl")


@register("match_ddl_tables", sql(r"""
select seq, kind, db, tbl from stmts where not ddl
 or regexp_full_match(lower(concat_ws('.', db, tbl)), 'shop\.t_[u-z].*|crm\.t_o.*', 'i')
 or (kind = 'RENAME' and regexp_full_match(lower(concat_ws('.', old_db, old_tbl)), 'shop\.t_[u-z].*|crm\.t_o.*', 'i'))""",
    "stmts"))
def match_ddl_tables(log: Log):
    return T.match_ddl_tables(log.statements, r"shop\.t_[u-z].*,crm\.t_o.*").select(
        "seq", "kind", "db", "tbl")


@register("allow_tables", sql("""
select server_id, seq, db, tbl from rows_ok where db || '.' || tbl in ('shop.t_user', 'crm.t_click')""", "rows_ok"))
def allow_tables(log: Log):
    rows = log.resolved.filter(F.col("table_error").isNull())
    return D.allow_tables(rows, ALLOW).select("server_id", "seq", "db", "tbl")


@register("allow_entries_strict", sql("""
select server_id, seq, entry_type from entries where db || '.' || tbl in ('shop.t_user', 'crm.t_click')""", "entries"))
def allow_entries_strict(log: Log):
    return D.allow_entries_strict(log.entries, ALLOW).select("server_id", "seq", "entry_type")


@register("allow_entries_open", sql("select server_id, seq, entry_type from entries", "entries"))
def allow_entries_open(log: Log):
    return D.allow_entries_open(log.entries, []).select("server_id", "seq", "entry_type")


@register("filtered_runs", sql("""
, g as (select *, db || '.' || tbl in ('shop.t_new', 'crm.t_tmp') k from entries),
h as (select *, sum(k::int) over (partition by server_id order by seq) grp from g),
i as (select *, row_number() over (partition by server_id, grp order by seq) rn from h where not k)
select server_id, seq, db || '.' || tbl last_name, rn run_length from i where rn % 500 = 0""", "entries"))
def filtered_runs(log: Log):
    return D.filtered_runs(log.entries, ["shop.t_new", "crm.t_tmp"], width=WIDTH)

"""Event classification and the context each event takes from the log before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators.ordered import DEFAULT_WIDTH, RANGE, latest

HEADER_COLUMNS = ["logfile", "logfile_offset", "execute_time", "event_length"]


def type_name_of(code: Column) -> Column:
    """Display name of an event code."""
    names = F.create_map(*[F.lit(x) for pair in S.EVENT_NAMES.items() for x in pair])
    return F.coalesce(names[code], F.lit(S.UNKNOWN_EVENT_NAME))


def event_type_name(raw: DataFrame) -> DataFrame:
    return raw.withColumn("type_name", type_name_of(F.col("type_code")))


def select_events(
    raw: DataFrame, start: int = 0, stop: int = S.EVENT_CODES_END, codes: list[int] | None = None
) -> DataFrame:
    """Keep codes in ``[start, stop)``, or exactly those in ``codes``."""
    if codes is not None:
        return raw.filter(code_in(codes))
    return raw.filter((F.col("type_code") >= start) & (F.col("type_code") < stop))


def convertible_events(raw: DataFrame) -> DataFrame:
    """Events that yield an entry; all others only change context or are dropped."""
    return raw.filter(code_in(S.CONVERTIBLE_CODES))


def code_in(codes: tuple[int, ...] | list[int]) -> Column:
    """The event code is one of these."""
    return F.expr(f"type_code IN ({', '.join(map(str, codes))})")


def row_kind() -> Column:
    """INSERT, UPDATE or DELETE; null for an event that changes no rows."""
    return (
        F.when(code_in(S.INSERT_CODES), "INSERT").when(code_in(S.UPDATE_CODES), "UPDATE")
        .when(code_in(S.DELETE_CODES), "DELETE")
    )


def is_rows_event() -> Column:
    return code_in(S.ROWS_CODES)


def row_event_kind(raw: DataFrame) -> DataFrame:
    """Row-change kind of each event; a code that is none of them gets an error."""
    kind = row_kind()
    message = F.concat(F.lit("unsupported event type: "), F.col("type_code").cast("string"))
    return raw.withColumn("event_type", kind).withColumn(
        "kind_error", F.when(kind.isNull(), message)
    )


def _rotated() -> Column:
    return F.when(F.col("type_code") == S.ROTATE, F.col("rotate_file"))


def closing_seq() -> Column:
    """Order value of a rows event that ends its statement, and so closes all maps."""
    flags = F.coalesce(F.col("flags"), F.lit(0))
    ends = is_rows_event() & (flags.bitwiseAND(S.END_OF_STATEMENT_FLAG) != 0)
    return F.when(ends, F.col("seq"))


def _file_or_default() -> Column:
    return F.coalesce("logfile", F.lit(S.DEFAULT_LOGFILE))


def attach_logfile(raw: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """File of the latest rotate at or before each event."""
    with_file = latest(raw, ["server_id"], "seq", {"logfile": _rotated()}, width=width)
    return with_file.withColumn("logfile", _file_or_default())


def resolve_table(raw: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Table of each rows event: the latest table map with its id, still open.

    A rows event that ends its statement closes every map up to itself, so a map
    counts only when it is later than the latest such event before the row.
    Adds ``db``/``tbl`` (in place of the map-only columns) and ``table_error``.
    """
    # Only these events matter here, and a filter this early reaches the scan.
    raw = raw.filter(_names_table())
    closed = latest(
        raw, ["server_id"], "seq", {"_closed": closing_seq()}, exclusive=["_closed"],
        keep_range=True, width=width,
    )
    rows = _resolve(closed, raw, width)
    return rows.filter(is_rows_event())


def with_context(
    raw: DataFrame, width: int = DEFAULT_WIDTH, keep_range: bool = False
) -> DataFrame:
    """Log file on every event, found in the same pass as the closing rows events."""
    both = latest(
        raw, ["server_id"], "seq", {"logfile": _rotated(), "_closed": closing_seq()},
        exclusive=["_closed"], keep_range=keep_range, width=width,
    )
    return both.withColumn("logfile", _file_or_default())


def resolved_events(raw: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Every event with its log file; rows events also with table or table_error."""
    return _resolve(with_context(raw, width, keep_range=True), raw, width)


def _names_table() -> Column:
    return (F.col("type_code") == S.TABLE_MAP) | is_rows_event()


def _resolve(closed: DataFrame, raw: DataFrame, width: int) -> DataFrame:
    keep = [c for c in closed.columns if c not in ("db", "tbl", "_closed", RANGE)]
    a_map = F.struct(F.col("seq").alias("at"), "db", "tbl")
    mapped = latest(
        closed, ["server_id", "table_id"], "seq",
        {"_map": F.when(F.col("type_code") == S.TABLE_MAP, a_map)},
        source=raw.filter(_names_table()), width=width,
    )
    still_open = F.col("_map.at") > F.coalesce("_closed", F.lit(-(1 << 62)))
    open_map = F.when(is_rows_event() & still_open, F.col("_map"))
    missing = F.concat(F.lit("not found tableId:"), F.col("table_id").cast("string"))
    return mapped.withColumn("_open", open_map).select(
        *keep,
        F.col("_open.db").alias("db"),
        F.col("_open.tbl").alias("tbl"),
        F.when(is_rows_event() & F.col("_open").isNull(), missing).alias("table_error"),
    )


def header_columns() -> dict[str, Column]:
    return {
        "logfile_offset": F.col("log_pos") - F.col("event_len"),
        "execute_time": F.unix_seconds(F.col("ts").cast("timestamp")) * 1000,
        "event_length": F.col("event_len"),
    }


def build_header(events: DataFrame) -> DataFrame:
    """Entry header of each event; markers have an empty schema and table."""
    cols = header_columns()
    header = F.struct(
        F.lit(S.HEADER_VERSION).alias("version"),
        F.col("logfile").alias("logfile_name"),
        cols["logfile_offset"].alias("logfile_offset"),
        F.col("server_id"),
        F.lit(S.HEADER_ENCODING).alias("server_encode"),
        cols["execute_time"].alias("execute_time"),
        F.lit(S.HEADER_SOURCE).alias("source_type"),
        F.coalesce("db", F.lit("")).alias("schema_name"),
        F.coalesce("tbl", F.lit("")).alias("table_name"),
        cols["event_length"].alias("event_length"),
        row_kind().alias("event_type"),
    )
    return events.withColumn("header", header)


def _ends_with(word: str) -> Column:
    return F.coalesce(F.endswith(F.upper("query"), F.lit(word)), F.lit(False))


def is_begin() -> Column:
    return (F.col("type_code") == S.QUERY) & _ends_with("BEGIN")


def is_commit() -> Column:
    return (F.col("type_code") == S.QUERY) & _ends_with("COMMIT")


def _as_entries(events: DataFrame, **columns: Column) -> DataFrame:
    """Project events to the entry shape; columns not named are null."""
    cols = {**header_columns(), **columns}
    return events.select(*[
        (cols[f.name] if f.name in cols
         else F.col(f.name) if f.name in ("server_id", "seq", "type_code", "logfile")
         else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.ENTRY.fields
    ])


def transaction_markers(events: DataFrame) -> DataFrame:
    """BEGIN / COMMIT / xid events as transaction entries."""
    is_xid = F.col("type_code") == S.XID
    marks = events.filter(is_xid | is_begin() | is_commit())
    return _as_entries(
        marks,
        db=F.lit(""), tbl=F.lit(""), is_ddl=F.lit(False),
        entry_type=F.when(is_begin(), "TRANSACTIONBEGIN").otherwise("TRANSACTIONEND"),
        thread_id=F.when(is_begin(), F.col("session_id")),
        transaction_id=F.when(is_xid, F.col("xid").cast("string")).when(~is_begin(), "0"),
    )


def statement_text() -> Column:
    """Statement text carried or implied by the non-query statement events."""
    code, name, text = F.col("type_code"), F.col("var_name"), F.col("var_text")
    assign = F.concat(F.lit("SET @"), name, F.lit(" := "))
    return (
        F.when(code_in([S.ROWS_QUERY, S.ANNOTATE_ROWS]), F.col("query"))
        .when(code == S.INTVAR, F.concat(F.lit("SET INSERT_ID = "), F.col("num1").cast("string")))
        .when(code == S.RAND, F.concat(
            F.lit("SET SESSION rand_seed1 = "), F.col("num1").cast("string"),
            F.lit(" , rand_seed2 = "), F.col("num2").cast("string")))
        .when((code == S.USER_VAR) & text.isNull(), F.concat(assign, F.lit("NULL")))
        .when((code == S.USER_VAR) & (F.col("var_type") == S.USER_VAR_STRING),
              F.concat(assign, F.lit("'"), text, F.lit("'")))
        .when(code == S.USER_VAR, F.concat(assign, text))
    )


def statement_entries(events: DataFrame) -> DataFrame:
    """Rows-query, annotate, intvar, rand and user-var events as QUERY entries."""
    found = events.filter(code_in(S.STATEMENT_CODES))
    return _as_entries(
        found, db=F.lit(""), tbl=F.lit(""), is_ddl=F.lit(False), event_type=F.lit("QUERY"),
        entry_type=F.lit("ROWDATA"), sql=statement_text(),
    )


def row_entries(resolved: DataFrame) -> DataFrame:
    """Resolved rows events as entries (their images travel in the cell table)."""
    return _as_entries(
        resolved.filter(F.col("table_error").isNull()),
        db=F.col("db"), tbl=F.col("tbl"), event_type=row_kind(),
        entry_type=F.lit("ROWDATA"), is_ddl=F.lit(False),
    )


def event_trace(events: DataFrame) -> DataFrame:
    """One line per event: name, position now, next position, file, statement."""
    return events.select(
        "server_id", "seq", type_name_of(F.col("type_code")).alias("type_name"),
        (F.col("log_pos") - F.col("event_len")).alias("now_pos"),
        F.col("log_pos").alias("next_pos"), "logfile",
        F.when(F.col("type_code") == S.QUERY, F.col("query")).alias("sql"),
    )

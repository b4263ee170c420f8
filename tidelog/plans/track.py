"""Whole change-tracking plans.

Steps with several readers are written to the shared folder while a plan is built, so a call runs a
few jobs before it returns; the returned tables are lazy from there on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators import checkpoints as P
from tidelog.operators import columns as E
from tidelog.operators import context as C
from tidelog.operators import filters as D
from tidelog.operators import sequence as Q
from tidelog.functions import text as X
from tidelog.operators import statements as T
from tidelog.operators.ordered import DEFAULT_WIDTH, merged
from tidelog.sources.shared import stored_by, written
from tidelog.sources.publish import publish_changes
from tidelog.sources.store import append_event_rows
from tidelog import schemas as S

ENTRY_FIELDS = [f.name for f in S.ENTRY.fields]
#: Columns of the rejected events a plan returns.
REJECTED = ["server_id", "seq", "logfile", "logfile_offset", "reason"]
#: Columns written beside a message's value, and those of them that a plan does not return.
NOT_SENT = ["logfile", "logfile_offset", "body_reason", "entry_type", "is_ddl"]
KEPT_BESIDE = ("server_id", "seq", "batch_id", "in_id", *NOT_SENT)


def judged_entries(
    raw: DataFrame, allow: Sequence[str] = (), *, ddl_patterns: str | None = None,
    row_patterns: str | None = None, no_ddl: bool = False, no_dml: bool = False,
    no_dcl: bool = False, width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Every entry of the log, and with a ``reason`` each event that should give one but cannot.

    The allowlist and ``row_patterns`` (whole ``db.table`` names, any case) apply to rows events,
    ``ddl_patterns`` to DDL. One projection over one pass of the log: no union of per-kind branches
    that would each attach context again.
    """
    # Other events change no context; dropped here, before the windows, they are not shuffled.
    needed = raw.filter(C.code_in([*S.CONVERTIBLE_CODES, S.ROTATE, S.TABLE_MAP]))
    return judged_events(
        C.resolved_events(needed, width), allow, ddl_patterns=ddl_patterns,
        row_patterns=row_patterns, no_ddl=no_ddl, no_dml=no_dml, no_dcl=no_dcl)


def judged_events(
    resolved: DataFrame, allow: Sequence[str] = (), *, ddl_patterns: str | None = None,
    row_patterns: str | None = None, no_ddl: bool = False, no_dml: bool = False,
    no_dcl: bool = False,
) -> DataFrame:
    """``judged_entries`` of events that have their context, for callers that read it themselves."""
    events = C.convertible_events(resolved)
    if no_ddl and no_dml and no_dcl:  # no statement can pass, so none is parsed
        events = events.filter(~T.is_statement())
    events = T.with_statement(events)
    row, begin, stmt = C.is_rows_event(), C.is_begin(), F.col("stmt").isNotNull()
    end = (F.col("type_code") == S.XID) | C.is_commit()
    text = C.code_in(S.STATEMENT_CODES)
    row_passes = F.col("table_error").isNull()
    if len(allow):
        row_passes = row_passes & D.full_name().isin(list(allow))
    if row_patterns is not None:
        row_passes = row_passes & X.matches_any_ci(D.full_name(), row_patterns)
    reason = F.coalesce(F.when(row, F.col("table_error")), F.when(stmt, T.ddl_error("stmt.")))
    stmt_passes = (
        T.ddl_error("stmt.").isNull() & T.ddl_matches(ddl_patterns, "stmt.")
        & T.class_passes(no_ddl, no_dml, no_dcl, "stmt.")
    )
    kept = events.filter(
        (row & row_passes) | begin | end | (stmt & stmt_passes) | (text & F.lit(not no_dml))
        | reason.isNotNull())

    def by_kind(of_row: Column, of_stmt: Column) -> Column:
        return F.coalesce(F.when(row, of_row).when(stmt, of_stmt), F.lit(""))

    header = C.header_columns()
    xid = F.when(F.col("type_code") == S.XID, F.col("xid").cast("string"))
    columns = {
        **header,
        "db": by_kind(F.col("db"), F.col("stmt.db")),
        "tbl": by_kind(F.col("tbl"), F.col("stmt.tbl")),
        "event_type": F.when(row, C.row_kind())
                       .when(stmt & T.is_ddl("stmt."), F.col("stmt.kind"))
                       .when(stmt | text, F.lit("QUERY")),
        "entry_type": F.when(begin, "TRANSACTIONBEGIN").when(end, "TRANSACTIONEND")
                       .otherwise("ROWDATA"),
        "is_ddl": F.coalesce(F.col("stmt.kind") != "QUERY", F.lit(False)),
        "transaction_id": F.when(end, F.coalesce(xid, F.lit("0"))),
        "thread_id": F.when(begin, F.col("session_id")),
        "sql": F.when(stmt, F.col("query")).otherwise(C.statement_text()),
    }
    return kept.select(*[
        columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.ENTRY.fields
    ], reason.alias("reason"))


def all_entries(raw: DataFrame, allow: Sequence[str] = (), **options) -> DataFrame:
    """The entries of the log; options as for ``judged_entries``."""
    return judged_entries(raw, allow, **options).filter(F.col("reason").isNull()).drop("reason")


def rejected_of(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).select(*REJECTED)


def held(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of each server before its first rejected event."""
    first = rejected.groupBy("server_id").agg(F.min("seq").alias("_first"))
    # One row a server, written so that its measured size decides how it is joined.
    return rows.join(written(first, "first_rejected"), "server_id", "left").filter(
        F.col("_first").isNull() | (F.col("seq") < F.col("_first"))).drop("_first")


def resumed(judged: DataFrame, start: DataFrame) -> DataFrame:
    """Rows at or after their server's start; servers without one begin at the log's begin."""
    at = start.select("server_id", F.col("logfile").alias("_file"), F.col("pos").alias("_pos"))
    here = P.position_key(F.col("logfile"), F.col("logfile_offset"))
    return judged.join(at, "server_id", "left").filter(
        F.col("_file").isNull() | (here >= P.position_key(F.col("_file"), F.col("_pos")))
    ).drop("_file", "_pos")


def continued(passing: DataFrame, start: DataFrame, width: int) -> DataFrame:
    """Numbered entries, each server continuing at its start's ids."""
    ids = start.select(
        "server_id", F.col("batch_id").alias("_b0"), F.col("in_id").alias("_i0"))
    zero = F.lit(0).cast("bigint")
    return Q.assign_batch_ids(
        passing.join(ids, "server_id", "left"), F.coalesce("_b0", zero), F.coalesce("_i0", zero),
        width).drop("_b0", "_i0")


def numbered_in_place(passing: DataFrame, start: DataFrame | None, width: int) -> DataFrame:
    """The entries with their ids, left where they lie: only key and end mark move to the ranges in
    which ids are counted, and key and ids back to the entries."""
    narrow = passing.select(*E.EVENT_KEY, "entry_type", "is_ddl")
    ids = Q.assign_batch_ids(narrow, width=width) if start is None else continued(
        narrow, start, width)
    return merged(passing, ids.select(*E.EVENT_KEY, "batch_id", "in_id"), E.EVENT_KEY)


def second_filter(entries: DataFrame, allow: Sequence[str], markers: str = "drop") -> DataFrame:
    """The filter on entries.

    ``markers='drop'``: markers go too, so batches advance on listed DDL only.
    ``markers='keep'``: markers stay and batches advance on every commit.
    """
    if markers == "drop":
        return D.allow_entries_strict(entries, allow)
    if not len(allow):
        return entries
    return entries.filter(
        (F.col("entry_type") != "ROWDATA") | D.full_name().isin(list(allow)))


def kept_entries(
    raw: DataFrame, allow: Sequence[str], *, markers: str = "drop",
    batch0: int | Column = 0, in0: int | Column = 0, width: int = DEFAULT_WIDTH, **classes,
) -> DataFrame:
    """Entries that pass the second filter, numbered.

    Numbering reads its input twice (totals, then rows), so the narrow entries are
    written once instead of attaching context twice.
    """
    entries = all_entries(raw, allow, width=width, **classes)
    kept = written(second_filter(entries, allow, markers), "kept")
    return Q.assign_batch_ids(kept, batch0, in0, width)


def track_rows(raw: DataFrame, allow: Sequence[str], width: int = DEFAULT_WIDTH) -> DataFrame:
    """The minimum slice: one numbered line per kept rows event or commit."""
    entries = all_entries(raw, allow, no_ddl=True, no_dml=True, no_dcl=True, width=width)
    kept = entries.filter(F.col("entry_type") != "TRANSACTIONBEGIN")
    return Q.assign_batch_ids(written(kept, "kept"), width=width)


def has_versions(meta: DataFrame) -> bool:
    """Whether a table has several versions of its metadata."""
    return "version" in meta.columns and bool(meta.groupBy("db", "tbl").agg(
        F.count_distinct("version").alias("n")).filter("n > 1").take(1))


def described_cells(
    kept: DataFrame, cells: DataFrame, meta: DataFrame, changes: DataFrame,
    before: DataFrame | None = None, width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Cells of the kept rows events with their columns' metadata.

    With several versions of a table's metadata each event gets the one in force at it: a statement
    in ``changes`` (server_id, seq, db, tbl) brings the next, and an event too wide for its
    version takes the next at once.
    """
    # Cells and entries meet on the event, the key every later step groups by.
    owners = kept.filter(F.col("event_type").isin("INSERT", "UPDATE", "DELETE")).select(
        *E.EVENT_KEY, "db", "tbl", "event_type")
    if not has_versions(meta):
        # Owners are few beside their cells, so a task hashes those of its events (shuffled, never
        # broadcast) and its cells are sorted once, by row, and not by event before.
        return E.enrich_columns(cells.join(owners.hint("shuffle_hash"), E.EVENT_KEY), meta)
    owners = T.with_versions(owners, changes, meta, before, width)
    return E.enrich_columns(E.fitting_version(merged(cells, owners, E.EVENT_KEY)), meta)


def row_bodies(
    kept: DataFrame, cells: DataFrame, meta: DataFrame, charset: str = "UTF-8", *,
    tz: str | None = None, changes: DataFrame | None = None, before: DataFrame | None = None,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Nested, enriched, rendered and compared row images of the kept rows events.

    ``body_reason`` says why an event's images cannot be named: its table has no metadata, or
    fewer columns than the event. ``changes`` (by default the statements in ``kept``) and
    ``before`` choose among versions of the metadata; ``tz`` is the zone of timestamps.
    """
    changes = T.column_changes(kept) if changes is None else changes
    described = described_cells(kept, cells, meta, changes, before, width)
    rendered = E.render_cells(described, charset, tz)
    shaped = rendered.select(
        *E.CELL_KEY, "image", "sql_type", "name", "is_key", F.lit(False).alias("updated"),
        F.concat_ws(".", "db", "tbl").alias("_table"),
        F.col("value").isNull().alias("is_null"), "value",
        F.col("column_type").alias("mysql_type"),
    )
    rows = E.flag_updated_images(E.row_images(shaped))
    # They come sorted so, as the planner finds too late by itself: no rows are sorted here.
    return rows.sortWithinPartitions(*E.EVENT_KEY).groupBy(*E.EVENT_KEY).agg(
        F.sort_array(F.collect_list(F.struct("row_idx", "before", "after"))).alias("row_datas"),
        F.max("width").alias("_width"), F.max("named").alias("_named"), F.max("_table").alias("_table"),
    ).select(*E.EVENT_KEY, "row_datas", E.column_error(
        F.col("_table"), F.col("_width"), F.col("_named")).alias("body_reason"))


def track_changes(
    raw: DataFrame, cells: DataFrame, meta: DataFrame, allow: Sequence[str], *,
    topic: str = "changes", markers: str = "keep",
    max_bytes: int = Q.SEND_BYTES, max_rows: int = Q.SEND_ROWS, width: int = DEFAULT_WIDTH,
    charset: str = "UTF-8", tz: str | None = None, skip_errors: bool = False,
    checkpoints: DataFrame | None = None, seed: DataFrame | None = None, **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw log to numbered, packed messages, the checkpoint to confirm after them, and the events
    rejected (unknown table id, DDL without a table, no or too narrow metadata).

    The checkpoint of a server stays at the last commit before its first rejected event, unless
    ``skip_errors``. An entry rejected for its metadata keeps its number, so numbers do not
    change when it goes through later. With ``checkpoints`` (server_id, logfile, pos, batch_id,
    in_id, as a run returns them) each server goes on from its own; ``raw`` may begin earlier,
    and table maps and changes of columns before the position still count. A checkpoint's ids are
    those as of its position, so what is sent again has the ids it had. ``meta`` may hold several
    versions of a table, ``tz`` is the zone of timestamps. ``seed``: the context at the checkpoints
    (``resume.context_at``); then ``raw`` need hold only events from the positions on. Entries and finished message values are each written once:
    both have several readers, and context must not be attached again for each of them.
    """
    # Written, so that its measured size decides how it is joined: a list or a remote table has none.
    meta = written(meta, "meta")
    before = None
    if seed is not None:
        is_line = F.col("type_code") == S.TABLE_LINE
        raw_columns = [f.name for f in S.RAW_EVENT.fields]
        before = seed.filter(is_line).select("server_id", "db", "tbl", "changes")
        raw = raw.select(*raw_columns).unionByName(seed.filter(~is_line).select(*raw_columns))
    # Stored by event: ids, cells and message numbers meet the entries without moving them.
    judged = stored_by(
        judged_entries(raw, allow, width=width, **options), "entries", E.EVENT_KEY)
    # The whole log's, also before the position.
    changes = T.column_changes(judged.filter(F.col("reason").isNull()))
    start = None
    if checkpoints is not None:
        # One row a server, written so that its measured size decides how it is joined.
        start = written(checkpoints.select(
            "server_id", "logfile", "pos", "batch_id", "in_id"), "start")
        judged = resumed(judged, start)
    entries = judged.filter(F.col("reason").isNull()).drop("reason")
    passing = second_filter(entries, allow, markers)
    kept = numbered_in_place(passing, start, width)
    bodies = row_bodies(
        passing, cells, meta, charset, tz=tz, changes=changes, before=before, width=width)
    full = merged(kept, bodies, E.EVENT_KEY, "left")
    value_columns = [*ENTRY_FIELDS, "batch_id", "in_id", "row_datas"]
    out = stored_by(publish_changes(full, topic, value_columns, keep=KEPT_BESIDE), "values",
                    E.EVENT_KEY, lies=True)
    bad = out.filter(F.col("body_reason").isNotNull()).withColumnRenamed("body_reason", "reason")
    rejected = rejected_of(judged).unionByName(bad.select(*REJECTED))
    good = out.filter(F.col("body_reason").isNull()).drop(*NOT_SENT)
    messages = Q.pack_messages(good, F.octet_length("value"), max_bytes, max_rows, width=width)
    if not skip_errors:
        entries = held(entries, rejected)
    # The position comes from the last commit before the second filter; ids are sought up to there.
    return messages, P.make_checkpoint(P.last_commit(entries), out, start), rejected


def track_to_store(
    raw: DataFrame, cells: DataFrame, meta: DataFrame, patterns: str | None, next_key: int = 0,
    width: int = DEFAULT_WIDTH, skip_errors: bool = False, *, charset: str = "UTF-8",
    tz: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw log to stored rows under dense keys, the two-column checkpoint, and the rejected events.

    Keys and the hold of the checkpoint are as in ``track_changes``.
    """
    # Written, so that its measured size decides how it is joined: a list or a remote table has none.
    meta = written(meta, "meta")
    judged = written(judged_entries(raw, width=width), "entries")
    kept = D.match_tables(judged.filter(F.col("reason").isNull()).drop("reason"), patterns)
    # Written with their keys: the rows, their cells and the checkpoint read them.
    keyed = written(append_event_rows(kept, next_key, width=width), "keyed")
    changes = T.column_changes(judged.filter(F.col("reason").isNull()))
    bodies = row_bodies(keyed, cells, meta, charset, tz=tz, changes=changes, width=width)
    rows = written(merged(keyed, bodies, E.EVENT_KEY, "left"), "rows")
    bad = rows.filter(F.col("body_reason").isNotNull()).withColumnRenamed("body_reason", "reason")
    rejected = rejected_of(judged).unionByName(bad.select(*REJECTED))
    rows = rows.filter(F.col("body_reason").isNull()).drop("body_reason")
    if not skip_errors:
        keyed = held(keyed, rejected)
    ends = keyed.filter(P.is_commit("end_event")).groupBy("server_id").agg(
        F.max(F.struct("row_key", "logfile", "logfile_offset", "event_length")).alias("e"))
    checkpoint = ends.select(
        "server_id",
        F.concat_ws(":", "e.logfile", (F.col("e.logfile_offset") + F.col("e.event_length"))
                    .cast("string")).alias("binlog_xid"),
        (F.col("e.row_key") + 1).cast("string").alias("event_row_key"),
    )
    return rows, checkpoint, rejected


def simple_track(
    raw: DataFrame, cells: DataFrame, meta: DataFrame, allow: Sequence[str],
    width: int = DEFAULT_WIDTH, *, charset: str = "UTF-8", tz: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Listing of the effective image of each kept row with its table and position, and the
    rows events whose table is unknown. Cells without metadata are listed without a name."""
    # Written, so that its measured size decides how it is joined: a list or a remote table has none.
    meta = written(meta, "meta")
    resolved = written(C.resolved_events(raw, width).filter(C.is_rows_event()), "resolved")
    lost = resolved.filter(F.col("table_error").isNotNull()).select(
        "server_id", "seq", "logfile", C.header_columns()["logfile_offset"].alias("logfile_offset"),
        F.col("table_error").alias("reason"))
    rows = C.row_entries(D.allow_tables(resolved, allow)).select(
        *E.EVENT_KEY, "logfile", "logfile_offset", "execute_time", "db", "tbl", "event_type")
    if has_versions(meta):
        good, _ = T.quarantine_ddl(T.classify_statements(raw))
        changes = T.column_changes(good.withColumnsRenamed({"kind": "event_type", "query": "sql"}))
        rows = T.with_versions(rows, changes, meta, width=width)
        shown = E.effective_image(E.fitting_version(merged(cells, rows, E.EVENT_KEY)))
    else:
        shown = E.effective_image(merged(cells, rows, E.EVENT_KEY))
    rendered = E.render_cells(E.enrich_columns(shown, meta), charset, tz)
    listing = rendered.select(
        *E.CELL_KEY, "event_type", "execute_time",
        F.concat_ws(".", "db", "tbl").alias("dbtb"),
        F.concat_ws("#", "logfile", F.col("logfile_offset").cast("string")).alias("position"),
        "name", "value",
    )
    return listing, lost

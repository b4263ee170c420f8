"""Query events: classified, named, split into entries and quarantined text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import text as X
from tidelog.operators import context as C
from tidelog.operators.ordered import DEFAULT_WIDTH, latest, positions
from tidelog.sources.shared import written

INVALIDATING_KINDS = ["ALTER", "ERASE", "RENAME"]


def is_statement() -> Column:
    """A query event that is not a transaction marker."""
    return (F.col("type_code") == S.QUERY) & ~C.is_begin() & ~C.is_commit()


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression runs once per row.

    An alias would be copied into every predicate that reads it when Catalyst
    pushes filters down; the output of a generator is a plain value.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_statement(events: DataFrame) -> DataFrame:
    """Add ``stmt``: struct(kind, db, tbl, old_db, old_tbl); null on other events."""
    clean, default_db = F.col("_clean"), F.col("session_db")
    parsed = _once(
        events.withColumn("_clean", X.strip_comments(F.col("query"))), "_parsed",
        F.when(is_statement(), F.struct(
            X.statement_kind(clean).alias("kind"), X.table_text(clean).alias("table_text"),
            X.rename_origin(clean).alias("origin_text"))),
    )
    kind = F.col("_parsed.kind")
    table = X.table_name(F.col("_parsed.table_text"), default_db)
    origin = X.table_name(F.col("_parsed.origin_text"), default_db)
    is_rename = kind == "RENAME"
    stmt = F.struct(
        kind.alias("kind"),
        F.coalesce(F.nullif(table["db"], F.lit("")), default_db).alias("db"),
        F.nullif(table["tbl"], F.lit("")).alias("tbl"),
        F.when(is_rename, F.nullif(origin["db"], F.lit(""))).alias("old_db"),
        F.when(is_rename, F.nullif(origin["tbl"], F.lit(""))).alias("old_tbl"),
    )
    named = _once(parsed, "stmt", F.when(kind.isNotNull(), stmt))
    return named.drop("_clean", "_parsed")


def classify_statements(raw: DataFrame) -> DataFrame:
    """Kind and tables of every query event that is not a transaction marker."""
    rest = [c for c in raw.columns if c not in ("db", "tbl")]
    return with_statement(raw.filter(is_statement())).select(*rest, "stmt.*")


def _kind_in(kinds: list[str], prefix: str) -> Column:
    return F.expr(f"{prefix}kind IN ({', '.join(map(repr, kinds))})")


def is_ddl(prefix: str = "") -> Column:
    return _kind_in(X.DDL_KINDS, prefix)


def ddl_error(prefix: str = "") -> Column:
    """Why a classified DDL cannot become an entry, else null."""
    col = lambda n: F.col(prefix + n)
    return (
        F.when(is_ddl(prefix) & col("tbl").isNull(), "no table name found")
        .when((col("kind") == "RENAME") & col("old_tbl").isNull(), "no original table found")
    )


def quarantine_ddl(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statements that can become entries, and those that cannot with the reason."""
    checked = classified.withColumn("error", ddl_error())
    return (
        checked.filter(F.col("error").isNull()).drop("error"),
        checked.filter(F.col("error").isNotNull()),
    )


def ddl_matches(patterns: str | None, prefix: str = "") -> Column:
    """Not DDL, or DDL on a matching table; a RENAME also passes by its original."""
    name = F.concat_ws(".", f"{prefix}db", f"{prefix}tbl")
    old = F.concat_ws(".", f"{prefix}old_db", f"{prefix}old_tbl")
    renamed = F.col(f"{prefix}kind") == "RENAME"
    return (
        ~is_ddl(prefix) | X.matches_any_ci(name, patterns)
        | (renamed & X.matches_any_ci(old, patterns))
    )


def match_ddl_tables(classified: DataFrame, patterns: str | None) -> DataFrame:
    return classified.filter(ddl_matches(patterns))


def class_passes(no_ddl: bool, no_dml: bool, no_dcl: bool, prefix: str = "") -> Column:
    ddl, dml = is_ddl(prefix), _kind_in(X.DML_KINDS, prefix)
    dropped = F.lit(False)
    for switch, group in ((no_ddl, ddl), (no_dml, dml), (no_dcl, ~ddl & ~dml)):
        dropped = dropped | group if switch else dropped
    return ~dropped


def filter_statement_class(
    classified: DataFrame, no_ddl: bool = False, no_dml: bool = False, no_dcl: bool = False
) -> DataFrame:
    """Drop DDL, DML text or all other statements."""
    return classified.filter(class_passes(no_ddl, no_dml, no_dcl))


def ddl_entries(classified: DataFrame) -> DataFrame:
    """Query entries: header type is the DDL kind or QUERY, DML text still counts as DDL."""
    good, _ = quarantine_ddl(classified)
    extra = good.select(
        "*",
        F.col("kind").alias("change_type"),
        F.when(F.col("session_db") != "", F.col("session_db")).alias("ddl_schema"),
    )
    cols = {
        **C.header_columns(),
        "db": F.col("db"), "tbl": F.coalesce("tbl", F.lit("")), "sql": F.col("query"),
        "event_type": F.when(is_ddl(), F.col("kind")).otherwise("QUERY"),
        "entry_type": F.lit("ROWDATA"), "is_ddl": F.col("kind") != "QUERY",
    }
    return extra.select(
        *[
            (cols[f.name] if f.name in cols
             else F.col(f.name) if f.name in ("server_id", "seq", "type_code", "logfile")
             else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.ENTRY.fields
        ],
        "change_type", "ddl_schema",
    )


def validity_intervals(classified: DataFrame, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Per table, the seq intervals between statements that end its metadata.

    Interval 1 is open at the left; interval n+1 starts after the n-th statement. ``changes``
    counts the statements before it that changed the table's columns.
    The few statements concerned are written once, so the log is searched once.
    """
    good, _ = quarantine_ddl(classified)
    ends = written(good.filter(_kind_in(INVALIDATING_KINDS, "")).select(
        "server_id", "seq", "db", "tbl",
        X.changes_columns(X.strip_comments(F.col("query")), F.col("kind")).alias("changed")),
        "invalidations")
    by = ["server_id", "db", "tbl"]
    numbered = positions(ends, by, "seq", F.col("changed"), width=width).withColumn(
        "_back", -F.col("seq"))
    following = latest(
        numbered, by, "_back", {"valid_to": F.col("seq")}, exclusive=["valid_to"], width=width
    )
    later = following.select(
        *by, F.col("seq").alias("valid_from"), "valid_to",
        (F.col("rows_before") + 2).alias("interval"),
        (F.col("marks_before") + F.col("changed").cast("bigint")).alias("changes"),
    )
    first = ends.groupBy(*by).agg(F.min("seq").alias("valid_to")).select(
        *by, F.lit(None).cast("bigint").alias("valid_from"), "valid_to",
        F.lit(1).cast("bigint").alias("interval"), F.lit(0).cast("bigint").alias("changes"),
    )
    return first.unionByName(later)


def schema_versions(
    classified: DataFrame, meta: DataFrame, seen: DataFrame, width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Metadata columns with the interval in which each version is in force.

    ``seen`` holds the (server_id, db, tbl) met in the log. A table no statement
    touches keeps its first version for good. The next version comes into force with a statement
    that changes the table's columns; others only end an interval. Once such statements outnumber
    the known versions the last version stays in force.
    """
    by = ["server_id", "db", "tbl"]
    intervals = validity_intervals(classified, width)
    versions = meta.groupBy("db", "tbl").agg(F.max("version").cast("bigint").alias("_max"))
    placed = seen.select(*by).distinct().join(versions, ["db", "tbl"]).join(intervals, by, "left")
    first = F.lit(1).cast("bigint")
    chosen = placed.withColumn("interval", F.coalesce("interval", first)).withColumn(
        "version", F.least(F.coalesce("changes", F.lit(0)) + 1, "_max").cast("int")
    )
    return chosen.drop("_max", "changes").join(meta, ["db", "tbl", "version"])


def column_changes(entries: DataFrame) -> DataFrame:
    """server_id, seq, db, tbl of the entries that leave their table with other columns."""
    return entries.filter(F.col("event_type").isin(INVALIDATING_KINDS) & X.changes_columns(
        X.strip_comments(F.col("sql")), F.col("event_type"))).select("server_id", "seq", "db", "tbl")


def with_versions(
    rows: DataFrame, changes: DataFrame, meta: DataFrame, before: DataFrame | None = None,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Rows events with the metadata ``version`` in force at them, its columns ``_fits``, and
    ``_next``, the columns of the version after it, if there is one.

    ``changes``: the statements that changed columns (server_id, seq, db, tbl); each brings its
    table's next version into force. ``before``: server_id, db, tbl, changes of earlier parts of
    the log. Statements are lines of the log among its rows events, so an event finds the last one
    before it whatever the number of either; tables without metadata get nulls.
    """
    by = ["server_id", "db", "tbl"]
    marks = positions(written(changes, "column_changes"), by, "seq", width=width).select(
        *by, "seq", (F.col("rows_before") + 1).alias("_n"))
    placed = latest(rows.unionByName(marks, allowMissingColumns=True), by, "seq",
                    {"_n": F.col("_n")}, width=width).filter(F.col("event_type").isNotNull())
    passed = F.coalesce("_n", F.lit(0))
    if before is not None:
        placed = placed.join(written(before, "changes_before"), by, "left")
        passed = passed + F.coalesce("changes", F.lit(0))
    key = ["db", "tbl"]
    sizes = meta.groupBy(*key, "version").agg(F.count(F.lit(1)).alias("_fits"))
    ends = sizes.groupBy(*key).agg(F.min("version").alias("_low"), F.max("version").alias("_high"))
    after = sizes.select(*key, (F.col("version") - 1).alias("version"), F.col("_fits").alias("_next"))
    chosen = placed.join(ends, key, "left").withColumn(
        "version", F.least(F.col("_low") + passed, F.col("_high")).cast("int"))
    return chosen.join(sizes, [*key, "version"], "left").join(
        after, [*key, "version"], "left").select(*rows.columns, "version", "_fits", "_next")

"""Positions, checkpoints and resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators.ordered import DEFAULT_WIDTH, latest
from tidelog.sources.shared import written


def file_number(logfile: Column) -> Column:
    """Trailing number of a log file name; null when there is none."""
    digits = F.regexp_extract(logfile, r"(\d+)\z", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def position_key(logfile: Column, pos: Column) -> Column:
    """Sortable position: numeric file suffix, then byte position."""
    return F.struct(file_number(logfile).alias("file_no"), pos.cast("bigint").alias("pos"))


def compare_positions(file_a: Column, pos_a: Column, file_b: Column, pos_b: Column) -> Column:
    a, b = position_key(file_a, pos_a), position_key(file_b, pos_b)
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


COMMIT_RULES = ("transaction_end", "any_entry", "end_event")


def is_commit(rule: str = "transaction_end") -> Column:
    """Which entries a checkpoint may point at."""
    if rule == "transaction_end":
        return F.col("entry_type") == "TRANSACTIONEND"
    if rule == "any_entry":
        return F.lit(True)
    if rule == "end_event":  # xid, or a query event other than BEGIN
        not_begin = ~F.coalesce(F.endswith(F.upper("sql"), F.lit("BEGIN")), F.lit(False))
        return (F.col("type_code") == S.XID) | (
            (F.col("type_code") == S.QUERY) & not_begin
            & (F.col("entry_type") != "TRANSACTIONBEGIN"))
    raise ValueError(f"unknown commit rule: {rule}")


def last_commit(entries: DataFrame, rule: str = "transaction_end") -> DataFrame:
    """Position source per server: the latest committing entry, before any filter."""
    at = F.struct("seq", "logfile", "logfile_offset", "event_length", "execute_time")
    return (
        entries.filter(is_commit(rule)).groupBy("server_id")
        .agg(F.max(at).alias("c")).select("server_id", "c.*")
    )


def next_ids(kept: DataFrame, commits: DataFrame, starts: DataFrame) -> DataFrame:
    """server_id, batch_id, in_id: the ids that follow the last kept entry at or before each
    server's commit, or its start's ids where nothing is kept up to there.

    A server that keeps nothing at all has no line. ``commits`` and ``starts`` hold a row a server.
    """
    from tidelog.operators.sequence import ends_batch

    at = commits.select("server_id", F.col("seq").alias("_commit"))
    entry = F.struct("seq", "batch_id", "in_id", ends_batch().alias("end"))
    newest = kept.join(at, "server_id").groupBy("server_id").agg(
        F.max(F.when(F.col("seq") <= F.col("_commit"), entry)).alias("k"))
    first = starts.select(
        "server_id", F.col("batch_id").alias("_b0"), F.col("in_id").alias("_i0"))
    zero = F.lit(0).cast("bigint")
    ids = F.when(F.col("k").isNull(), F.struct(
        F.coalesce("_b0", zero).alias("batch_id"), F.coalesce("_i0", zero).alias("in_id"))).when(
        F.col("k.end"), F.struct((F.col("k.batch_id") + 1).alias("batch_id"), zero.alias("in_id"))
    ).otherwise(F.struct(F.col("k.batch_id").alias("batch_id"), (F.col("k.in_id") + 1).alias("in_id")))
    return newest.join(first, "server_id", "left").select("server_id", ids.alias("n")).select(
        "server_id", "n.*")


def make_checkpoint(
    commits: DataFrame, kept: DataFrame, starts: DataFrame | None = None
) -> DataFrame:
    """``file:end:batch:in`` per server that sent something.

    The position is the last commit of the unfiltered log. The ids are those as of that commit, not
    after the last kept entry: a run that resumes sends the entries of a transaction cut in the
    middle again, and they get the ids they had. ``starts``: server_id, batch_id, in_id the
    numbering began with, 0:0 where there is none.
    """
    # One row a server, written so that its measured size decides how it is joined.
    commits = written(commits, "commits")
    if starts is None:
        zero = F.lit(0).cast("bigint")
        starts = commits.select("server_id", zero.alias("batch_id"), zero.alias("in_id"))
    pos = F.col("logfile_offset") + F.col("event_length")
    return commits.join(next_ids(kept, commits, starts), "server_id").select(
        "server_id", "logfile", pos.alias("pos"), "batch_id", "in_id",
        F.concat_ws(":", "logfile", pos.cast("string"), F.col("batch_id").cast("string"),
                    F.col("in_id").cast("string")).alias("value"),
    )


def parse_checkpoint(value: Column) -> Column:
    """``struct(logfile, pos, batch_id, in_id, valid)`` of checkpoint text."""
    parts = F.split(value, ":")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
    complete = (
        (F.size(parts) == 4) & number(1).isNotNull() & number(2).isNotNull() & number(3).isNotNull()
    )
    valid = F.coalesce(complete, F.lit(False))
    return F.struct(
        F.when(valid, F.get(parts, F.lit(0))).alias("logfile"),
        F.when(valid, number(1)).alias("pos"),
        F.when(valid, number(2)).alias("batch_id"),
        F.when(valid, number(3)).alias("in_id"),
        valid.alias("valid"),
    )


def resolve_start(checkpoints: DataFrame, configured: DataFrame, master: DataFrame) -> DataFrame:
    """Where each job starts: stored checkpoint, configured offset, or master position.

    A stored value that is not four parts gives no start at all (``invalid``).
    """
    stored = checkpoints.select("job", "value").withColumn("c", parse_checkpoint(F.col("value")))
    conf = configured.select(
        "job", F.col("logfile").alias("conf_file"), F.col("offset").alias("conf_pos"))
    now = master.select(
        "job", F.col("logfile").alias("now_file"), F.col("pos").alias("now_pos"))
    joined = now.join(conf, "job", "left").join(stored, "job", "left")
    has_value = F.coalesce(F.col("value") != "", F.lit(False))
    source = (
        F.when(has_value & F.col("c.valid"), "checkpoint")
        .when(has_value, "invalid")
        .when(F.coalesce(F.col("conf_pos") > 0, F.lit(False)), "configured")
        .otherwise("master")
    )

    def pick(stored_col: str, conf_col: Column, now_col: Column) -> Column:
        return (
            F.when(F.col("source") == "checkpoint", F.col(f"c.{stored_col}"))
            .when(F.col("source") == "configured", conf_col)
            .when(F.col("source") == "master", now_col)
        )

    zero = F.lit(0).cast("bigint")
    return joined.withColumn("source", source).select(
        "job", "source",
        pick("logfile", F.col("conf_file"), F.col("now_file")).alias("logfile"),
        pick("pos", F.col("conf_pos"), F.col("now_pos")).alias("pos"),
        pick("batch_id", zero, zero).alias("batch_id"),
        pick("in_id", zero, zero).alias("in_id"),
    )


def resume_from(entries: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Entries starting at or after their server's checkpoint position."""
    # One row a server, written so that its measured size decides how it is joined.
    start = written(checkpoints.select(
        "server_id", F.col("logfile").alias("_file"), F.col("pos").alias("_pos")), "start")
    here = position_key(F.col("logfile"), F.col("logfile_offset"))
    return (
        entries.join(start, "server_id")
        .filter(here >= position_key(F.col("_file"), F.col("_pos"))).drop("_file", "_pos")
    )


def minute_checkpoints(
    numbered: DataFrame, job: str, form: str = "path", width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Per server and minute, the latest commit known at the end of that minute.

    ``numbered``: entries in log order with next_batch_id / next_in_id and ``ts``.
    One line per minute is aggregated first; the spine has one line per minute of
    the log, so nothing here grows with the number of entries.
    """
    minute = F.call_function("div", F.unix_seconds("ts"), F.lit(60).cast("bigint"))
    known = F.struct(
        "seq", "logfile", (F.col("logfile_offset") + F.col("event_length")).alias("pos"),
        "next_batch_id", "next_in_id",
    )
    per_minute = numbered.withColumn("minute", minute).groupBy("server_id", "minute").agg(
        F.max(F.when(F.col("entry_type") == "TRANSACTIONEND", known)).alias("commit")
    )
    spine = per_minute.groupBy("server_id").agg(
        F.explode(F.sequence(F.min("minute"), F.max("minute"))).alias("minute")
    )
    filled = latest(
        spine.join(per_minute, ["server_id", "minute"], "left"),
        ["server_id"], "minute", {"known": F.col("commit")}, width=width,
    )
    at = F.timestamp_seconds(F.col("minute") * 60)
    none = F.col("known").isNull()
    value = F.when(none, F.lit("null:-1:0:0")).otherwise(F.concat_ws(
        ":", "known.logfile", *[F.col(f"known.{c}").cast("string")
                                for c in ("pos", "next_batch_id", "next_in_id")]))
    if form == "path":
        key = F.concat(F.date_format(at, "yyyy-MM-dd/HH/HH:mm"), F.lit(f"/{job}"))
    else:
        key = F.concat(F.lit(f"{job}##"), F.date_format(at, "yyyy-MM-dd HH:mm"))
    return filled.select("server_id", key.alias("key"), value.alias("value"))


def dedup_replayed(entries: DataFrame, last_seen: DataFrame) -> DataFrame:
    """Drop entries a consumer already has, by (batch_id, in_id)."""
    seen = written(last_seen.select(
        "server_id", F.struct("batch_id", "in_id").alias("_seen")), "seen")
    fresh = entries.join(seen, "server_id", "left").filter(
        F.col("_seen").isNull() | (F.struct("batch_id", "in_id") > F.col("_seen"))
    )
    return fresh.drop("_seen").dropDuplicates(["server_id", "batch_id", "in_id"])


def validate_checkpoint(checkpoints: DataFrame, log_index: DataFrame, master: DataFrame) -> DataFrame:
    """Keep positions inside the retained logs; restart the others at the master."""
    index = log_index.select("server_id", "logfile", "first_pos", "last_pos")
    now = master.select(
        "server_id", F.col("logfile").alias("now_file"), F.col("pos").alias("now_pos"))
    checked = (
        checkpoints.join(index, ["server_id", "logfile"], "left").join(now, "server_id")
        .withColumn("retained", F.coalesce(
            F.col("pos").between(F.col("first_pos"), F.col("last_pos")), F.lit(False)))
    )
    zero = F.lit(0).cast("bigint")
    keep = F.col("retained")
    return checked.select(
        "job", "server_id", keep.alias("retained"),
        F.when(keep, F.col("logfile")).otherwise(F.col("now_file")).alias("logfile"),
        F.when(keep, F.col("pos")).otherwise(F.col("now_pos")).alias("pos"),
        F.when(keep, F.col("batch_id")).otherwise(zero).alias("batch_id"),
        F.when(keep, F.col("in_id")).otherwise(zero).alias("in_id"),
    )

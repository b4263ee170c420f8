"""Resuming without reading what lies before the checkpoint.

A position alone is not enough to go on from: the log file, the open table maps and how often each
table's columns changed come from events before it. ``context_at`` takes them as of a checkpoint, a
few rows a server, to be stored beside it; ``read_from`` reads only files from the position on;
``track_changes(..., seed=...)`` puts the one in front of the other. The next context is taken from
the last one and the files just read, so a log is read once, however often a job resumes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.operators import checkpoints as P
from tidelog.operators import context as C
from tidelog.operators import statements as Q
from tidelog.operators.ordered import DEFAULT_WIDTH
from tidelog.sources.shared import written
from tidelog.sources.store import write_change_log

RAW_COLUMNS = [f.name for f in S.RAW_EVENT.fields]
#: Events (a rotate, table maps) and lines of tables whose columns changed.
SEED = T.StructType([*S.RAW_EVENT.fields, T.StructField("changes", T.LongType())])
#: What a stored log is laid out by.
LAYOUT = ["server_id", "logfile"]


def store_log(raw: DataFrame, path: str, width: int = DEFAULT_WIDTH) -> None:
    """Store a log in a folder per server and log file, which a resumed read can skip."""
    write_change_log(C.attach_logfile(raw, width), path, LAYOUT)


def read_from(spark: SparkSession, path: str, checkpoints: DataFrame | None = None) -> DataFrame:
    """Stored events with their logfile, of each server from its checkpoint's position on.

    The condition on the file is one on the folders, so older files are not listed for reading;
    within the position's file the byte position reaches the scan. A server without a checkpoint is
    read whole. ``checkpoints`` has a row a server and is read by the driver, as what the plan is
    made from.
    """
    schema = T.StructType([*S.RAW_EVENT.fields, T.StructField("logfile", T.StringType())])
    log = spark.read.schema(schema).parquet(path)
    starts = [] if checkpoints is None else checkpoints.select(
        "server_id", P.file_number(F.col("logfile")).alias("file"), "pos").collect()
    if not starts:
        return log
    number, offset = P.file_number(F.col("logfile")), F.col("log_pos") - F.col("event_len")
    mine = [(F.col("server_id") == r.server_id) & (number >= r.file) & (
        (number > r.file) | (offset >= r.pos)) for r in starts]
    others = ~F.col("server_id").isin([r.server_id for r in starts])
    return log.filter(reduce(lambda a, b: a | b, mine, others))


def context_at(
    events: DataFrame, checkpoints: DataFrame, seed: DataFrame | None = None,
) -> DataFrame:
    """The context of each checkpointed server as of its position, see ``SEED``.

    ``events`` have their logfile; they may begin at an earlier checkpoint whose context is
    ``seed``. A rotate still carries the old file's byte position, so the border is the first
    other event at or after the position.
    """
    at = written(checkpoints.select(
        "server_id", F.col("logfile").alias("_file"), F.col("pos").alias("_pos")), "start")
    here = P.position_key(F.col("logfile"), F.col("log_pos") - F.col("event_len"))
    border = events.filter(F.col("type_code") != S.ROTATE).join(at, "server_id").filter(
        here >= P.position_key(F.col("_file"), F.col("_pos"))).groupBy("server_id").agg(
        F.min("seq").alias("_border"))
    border = written(at.select("server_id").join(border, "server_id", "left"), "border")
    old = events.select(*RAW_COLUMNS).join(border, "server_id").filter(
        F.col("_border").isNull() | (F.col("seq") < F.col("_border"))).drop("_border")
    table = ["server_id", "db", "tbl"]
    good, _ = Q.quarantine_ddl(Q.classify_statements(old))
    changes = Q.column_changes(good.withColumnsRenamed({"kind": "event_type", "query": "sql"})).select(
        *table, F.lit(1).cast("bigint").alias("changes"))
    if seed is not None:
        # Only servers that are resumed again.
        seed = seed.join(at.select("server_id"), "server_id", "left_semi")
        is_line = F.col("type_code") == S.TABLE_LINE
        old = old.unionByName(seed.filter(~is_line).select(*RAW_COLUMNS))
        changes = changes.unionByName(seed.filter(is_line).select(*table, "changes"))
    row = F.struct("seq", *[c for c in RAW_COLUMNS if c != "seq"])
    files = old.filter(F.col("type_code") == S.ROTATE).groupBy("server_id").agg(
        F.max_by(row, "seq").alias("r")).select("r.*")
    closed = old.groupBy("server_id").agg(F.max(C.closing_seq()).alias("_closed"))
    maps = old.filter(F.col("type_code") == S.TABLE_MAP).groupBy("server_id", "table_id").agg(
        F.max_by(row, "seq").alias("m")).join(closed, "server_id").filter(
        F.col("m.seq") > F.coalesce("_closed", F.lit(S.BEFORE_ALL))).select("m.*")
    lines = changes.groupBy(*table).agg(F.sum("changes").alias("changes")).withColumns({
        "type_code": F.lit(S.TABLE_LINE), "seq": F.lit(S.BEFORE_ALL)})

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SEED.fields])

    return shaped(files).unionByName(shaped(maps)).unionByName(shaped(lines))

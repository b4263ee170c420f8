"""Change logs as streams: reading, publishing at least once, and live tracking."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas as S
from tidelog.operators import checkpoints as P
from tidelog.operators import columns as E
from tidelog.operators import context as C
from tidelog.operators.ordered import DEFAULT_WIDTH, merged
from tidelog.plans import track as H
from tidelog.sources.publish import publish_changes

IMAGES = T.ArrayType(T.StructType([
    f for f in S.CELL.fields if f.name not in ("server_id", "seq")]))
# A live event carries its own row images, as the log does.
LIVE_EVENT = T.StructType([*S.RAW_EVENT.fields, T.StructField("images", IMAGES)])
#: The state after a micro-batch: per server a rotate with its file, next ids, last commit and open
#: message; its open table maps; and per table that changed columns a line with how often.
STATE = T.StructType([
    *S.RAW_EVENT.fields,
    *[T.StructField(n, T.LongType()) for n in (
        "next_batch_id", "next_in_id", "commit_pos", "message_no", "open_rows", "open_bytes",
        "changes")],
    T.StructField("commit_file", T.StringType()),
])
TABLE_LINE, FIRST = S.TABLE_LINE, S.BEFORE_ALL
#: Epochs whose state stays: the last, and the one before, which a retried batch reads.
EPOCHS = 2


def stream_change_log(
    spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType,
    starting: str | None = None, expected: int | None = None, key: str = "seq",
) -> DataFrame:
    """A live log. A topic begins at ``starting`` and survives lost offsets; rows
    below the expected key are skipped. Other formats read files of ``schema`` from the first one
    on, whatever is there: for them ``starting`` can only be ``earliest``, which is their default."""
    reader = spark.readStream.format(fmt).options(**options)
    starting = starting or ("latest" if fmt == "kafka" else "earliest")
    if fmt != "kafka" and starting != "earliest":
        raise ValueError(f"{fmt} streams cannot start at {starting!r}")
    if fmt == "kafka":
        reader = reader.option("startingOffsets", starting).option("failOnDataLoss", "false")
        parsed = F.from_json(F.col("value").cast("string"), schema).alias("e")
        log = reader.load().select(parsed).select("e.*")
    else:
        log = reader.schema(schema).load()
    return log if expected is None else log.filter(F.col(key) >= expected)


def _epoch_path(path: str, epoch: int) -> str:
    return f"{path.rstrip('/')}/epoch={epoch}"


def _drop_older(spark: SparkSession, path: str, epoch: int) -> None:
    """Remove the state of epochs that no retry can read any more. Called after an epoch's state is
    complete; what a stopped run leaves behind goes with the next one."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(fs_path(path)):
        name, _, number = status.getPath().getName().partition("=")
        if name == "epoch" and number.isdigit() and int(number) <= epoch - EPOCHS:
            fs.delete(status.getPath(), True)


def publish_at_least_once(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], state_path: str,
    checkpoint_path: str, position: Column | None = None, **trigger,
) -> StreamingQuery:
    """Send a micro-batch, then confirm its position.

    The position is written only after the sink returned. A failure in between
    repeats the batch, so a reader drops repeats by their ids. An epoch's state holds the
    positions of every server seen so far, so only the last two are kept.
    """
    at = F.struct("seq", "logfile", "logfile_offset") if position is None else position

    def send(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.persist()  # read by the sink and by the position
        try:
            sink(batch, epoch)
            confirmed = batch.groupBy("server_id").agg(F.max(at).alias("p"))
            if epoch > 0:
                before = spark.read.parquet(_epoch_path(state_path, epoch - 1))
                confirmed = confirmed.unionByName(before.select("server_id", F.struct(
                    *[c for c in before.columns if c != "server_id"]).alias("p"))).groupBy(
                    "server_id").agg(F.max("p").alias("p"))
            confirmed.select("server_id", "p.*").write.mode("overwrite").parquet(
                _epoch_path(state_path, epoch))
            _drop_older(spark, state_path, epoch)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def confirmed_positions(spark: SparkSession, state_path: str) -> DataFrame:
    """Newest confirmed position of each server, from the epochs that are kept."""
    return (
        spark.read.parquet(state_path).groupBy("server_id")
        .agg(F.max(F.struct("seq", "logfile", "logfile_offset")).alias("p"))
        .select("server_id", "p.*")
    )


def initial_state(
    checkpoints: DataFrame, log_index: DataFrame | None = None, master: DataFrame | None = None,
) -> DataFrame:
    """The state before the first micro-batch, from a run's checkpoints (server_id, logfile, pos,
    batch_id, in_id).

    With ``log_index`` (server_id, logfile, first_pos, last_pos of the retained files) and ``master``
    (server_id, logfile, pos) a position that is no longer retained starts at the master's.
    """
    if log_index is not None:
        named = checkpoints.withColumn("job", F.col("server_id").cast("string"))
        checkpoints = P.validate_checkpoint(named, log_index, master)
    at = {"server_id": F.col("server_id"), "type_code": F.lit(S.ROTATE), "seq": F.lit(FIRST),
          "rotate_file": F.col("logfile"), "commit_file": F.col("logfile"), "commit_pos": F.col("pos"),
          "next_batch_id": F.col("batch_id"), "next_in_id": F.col("in_id"), "message_no": F.lit(0),
          "open_rows": F.lit(0), "open_bytes": F.lit(0)}
    return checkpoints.select(*[
        at.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])


def cells_of(events: DataFrame) -> DataFrame:
    """Cell table of live events."""
    return events.select("server_id", "seq", F.inline("images"))


def _packed(
    messages: DataFrame, before: DataFrame, max_bytes: int, max_rows: int, width: int,
) -> tuple[DataFrame, DataFrame]:
    """Messages with ``message_no``, and per server its open message after them.

    A message left open by earlier batches is put in front as rows without content that hold its
    size, fewer than ``max_rows``: the same packing then goes on where it stopped.
    """
    was = before.filter(F.col("type_code") == S.ROTATE).select(
        "server_id", F.coalesce("message_no", F.lit(0)).alias("_no"), "open_rows", "open_bytes")
    was = H.written(was, "open")
    held = was.filter("open_rows > 0").select("server_id", F.posexplode(F.concat(
        F.array("open_bytes"), F.array_repeat(F.lit(0).cast("bigint"), (F.col(
            "open_rows") - 1).cast("int"))))).select(
        "server_id", (F.lit(FIRST) + F.col("pos")).alias("seq"), F.col("col").alias("size"))
    sizes = messages.select("server_id", "seq", F.octet_length("value").cast("bigint").alias("size"))
    # Only servers with something new: an open message alone stays as it is.
    fresh = sizes.select("server_id").distinct()
    rows = H.written(sizes.unionByName(held.join(fresh, "server_id", "left_semi")), "sizes")
    packed = H.Q.pack_messages(rows, F.col("size"), max_bytes, max_rows, width=width)
    packed = packed.join(was.select("server_id", "_no"), "server_id", "left").withColumn(
        "message_no", F.col("message_no") + F.coalesce("_no", F.lit(0)))
    packed = H.written(packed.select("server_id", "seq", "size", "message_no"), "packed")
    last = packed.groupBy("server_id", "message_no").agg(
        F.count("*").alias("n"), F.sum("size").alias("b")).groupBy("server_id").agg(
        F.max(F.struct("message_no", "n", "b")).alias("m"))
    closed = (F.col("m.b") >= max_bytes) | (F.col("m.n") >= max_rows)
    zero = F.lit(0).cast("bigint")
    opened = last.select(
        "server_id", (F.col("m.message_no") + closed.cast("bigint")).alias("no"),
        F.when(closed, zero).otherwise(F.col("m.n")).alias("n"),
        F.when(closed, zero).otherwise(F.col("m.b")).alias("b"))
    return merged(messages, packed.select("server_id", "seq", "message_no"), E.EVENT_KEY), opened


def _carry(
    log: DataFrame, entries: DataFrame, kept: DataFrame, before: DataFrame, opened: DataFrame,
) -> DataFrame:
    """State after a batch: per server its current file, ids and open message, and its open maps.

    The rows are themselves log events (a rotate and table maps), so the next batch
    just puts them in front of its own. Tables that changed columns have a line of their own.
    """
    by = "server_id"
    is_map, is_rotate = F.col("type_code") == S.TABLE_MAP, F.col("type_code") == S.ROTATE
    seen = log.groupBy(by).agg(
        F.max(F.when(is_rotate, F.struct("seq", "rotate_file"))).alias("r"),
        F.max(C.closing_seq()).alias("closed"), F.min("seq").alias("first"),
    )
    ids = kept.groupBy(by).agg(
        F.max(F.struct("seq", "batch_id", "in_id", H.Q.ends_batch().alias("ends"))).alias("k"))
    end_pos = (F.col("logfile_offset") + F.col("event_length")).alias("pos")
    commits = P.last_commit(entries).select(by, F.struct("seq", "logfile", end_pos).alias("c"))
    old = before.filter(is_rotate).select(
        by, F.col("next_batch_id").alias("b0"), F.col("next_in_id").alias("i0"),
        F.col("commit_file").alias("f0"), F.col("commit_pos").alias("p0"),
        F.struct(F.col("message_no").alias("no"), F.col("open_rows").alias("n"),
                 F.col("open_bytes").alias("b")).alias("o0"))
    ends, k = F.col("k.ends"), F.col("k.batch_id")
    joined = seen.join(ids, by, "left").join(commits, by, "left").join(old, by, "left").join(
        opened, by, "left")
    zero = F.lit(0)
    current = {
        "type_code": F.lit(S.ROTATE), "seq": F.coalesce("r.seq", F.col("first") - 1),
        "rotate_file": F.coalesce("r.rotate_file", F.lit(S.DEFAULT_LOGFILE)),
        "next_batch_id": F.coalesce(F.when(ends, k + 1).otherwise(k), "b0", zero),
        "next_in_id": F.coalesce(
            F.when(ends, zero).otherwise(F.col("k.in_id") + 1), "i0", zero),
        "commit_file": F.coalesce("c.logfile", "f0"), "commit_pos": F.coalesce("c.pos", "p0"),
        "message_no": F.coalesce("no", "o0.no", zero), "open_rows": F.coalesce("n", "o0.n", zero),
        "open_bytes": F.coalesce("b", "o0.b", zero), "server_id": F.col(by),
    }
    files = joined.select(*[
        current.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])
    maps = log.filter(is_map).groupBy(by, "table_id").agg(
        F.max(F.struct("seq", "db", "tbl")).alias("m"))
    still = maps.join(seen.select(by, "closed"), by).filter(
        F.col("m.seq") > F.coalesce("closed", F.lit(FIRST)))
    mapped = {"server_id": F.col(by), "table_id": F.col("table_id"), "type_code": F.lit(S.TABLE_MAP),
              "seq": F.col("m.seq"), "db": F.col("m.db"), "tbl": F.col("m.tbl")}
    open_maps = still.select(*[
        mapped.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])
    table = ["server_id", "db", "tbl"]
    changed = H.T.column_changes(entries).select(*table, F.lit(1).cast("bigint").alias("changes")).unionByName(
        before.filter(F.col("type_code") == TABLE_LINE).select(*table, "changes")).groupBy(*table).agg(
        F.sum("changes").alias("changes"))
    line = {**{c: F.col(c) for c in (*table, "changes")}, "type_code": F.lit(TABLE_LINE),
            "seq": F.lit(FIRST)}
    tables = changed.select(*[
        line.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])
    return files.unionByName(open_maps).unionByName(tables)


def track_batch(
    batch: DataFrame, epoch: int, meta: DataFrame, allow: Sequence[str], state_path: str,
    sink_path: str, *, topic: str = "changes", markers: str = "keep", width: int = DEFAULT_WIDTH,
    max_bytes: int = H.Q.SEND_BYTES, max_rows: int = H.Q.SEND_ROWS, charset: str = "UTF-8",
    tz: str | None = None, start: DataFrame | None = None,
) -> None:
    """Track one micro-batch: read the state before it, write messages, then the state after.

    ``start``: the state before epoch 0. All outputs are replaced per epoch, so a batch run twice
    leaves them as once. Messages are packed across batches. Rejected events go to ``sink_path`` +
    "-rejected"; a micro-batch cannot be held, so watch that table.
    """
    spark = batch.sparkSession
    if epoch > 0:
        before = spark.read.schema(STATE).parquet(_epoch_path(state_path, epoch - 1))
    else:
        before = spark.createDataFrame([], STATE) if start is None else H.written(start, "start")
    raw_columns = [f.name for f in S.RAW_EVENT.fields]
    is_event = F.col("type_code") != TABLE_LINE
    log = before.filter(is_event).select(*raw_columns).unionByName(batch.select(*raw_columns))
    judged = H.judged_entries(log, allow, width=width)
    if start is not None:  # nothing of a server before the position it starts at
        judged = H.resumed(judged, start.select(
            "server_id", F.col("commit_file").alias("logfile"), F.col("commit_pos").alias("pos")))
    judged = H.written(judged, "live")
    entries = judged.filter(F.col("reason").isNull()).drop("reason")
    passing = H.second_filter(entries, allow, markers)
    kept = H.continued(passing, before.filter(F.col("type_code") == S.ROTATE).select(
        "server_id", F.col("next_batch_id").alias("batch_id"),
        F.col("next_in_id").alias("in_id")), width)
    bodies = H.row_bodies(
        passing, cells_of(batch), meta, charset, tz=tz, changes=H.T.column_changes(entries),
        before=before.filter(F.col("type_code") == TABLE_LINE).select(
            "server_id", "db", "tbl", "changes"), width=width)
    full = merged(kept, bodies, E.EVENT_KEY, "left")
    columns = [*H.ENTRY_FIELDS, "batch_id", "in_id", "row_datas"]
    out = H.written(publish_changes(full, topic, columns, keep=H.KEPT_BESIDE), "live")
    bad = out.filter(F.col("body_reason").isNotNull()).withColumnRenamed("body_reason", "reason")
    rejected = H.rejected_of(judged).unionByName(bad.select(*H.REJECTED))
    rejected.write.mode("overwrite").parquet(_epoch_path(sink_path + "-rejected", epoch))
    messages, opened = _packed(out.filter(F.col("body_reason").isNull()).drop(*H.NOT_SENT), before,
                               max_bytes, max_rows, width)
    messages.write.mode("overwrite").parquet(_epoch_path(sink_path, epoch))
    _carry(log, entries, out, before, opened).write.mode("overwrite").parquet(
        _epoch_path(state_path, epoch))
    _drop_older(spark, state_path, epoch)


def track_changes_stream(
    stream: DataFrame, meta: DataFrame, allow: Sequence[str], state_path: str, sink_path: str,
    checkpoint_path: str, *, trigger: dict | None = None, checkpoints: DataFrame | None = None,
    log_index: DataFrame | None = None, master: DataFrame | None = None, **options,
) -> StreamingQuery:
    """Live tracking with carried context. Micro-batches must follow log order.

    With ``checkpoints`` (as ``track_changes`` returns them) each server starts at its own, checked
    against ``log_index`` and ``master`` where given, see ``initial_state``.
    """
    start = None if checkpoints is None else H.written(
        initial_state(checkpoints, log_index, master), "start")
    # Written, so that its measured size decides how it is joined: a list or a remote table has none.
    meta = H.written(meta, "meta")

    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist()  # read for entries, row images and the carried state
        try:
            track_batch(batch, epoch, meta, allow, state_path, sink_path, start=start, **options)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )

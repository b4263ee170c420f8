"""Lag, throughput and the monitoring messages that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.checkpoints import file_number
from tidelog.operators.ordered import DEFAULT_WIDTH, latest

BYTES_PER_MB = 1024 * 1024
WINDOW = "60 seconds"

# --- Fixed values: message ids and field names of the monitoring envelope ----
FETCH, SEND, EXCEPTION, ADDRESS = 20001, 20002, 20003, 20004
LEGACY_FETCH, LEGACY_SEND = 20000, 20001
MARK = "mark"
CONTENT = (
    "FETCH_ROWS bigint, FETCH_SIZE bigint, DELAY_NUM double, SEND_ROWS bigint, "
    "SEND_SIZE bigint, SEND_TIME bigint, DELAY_TIME bigint, EXCEPTION string, IP string"
)
# --- End of fixed values ----------------------------------------------------


def position_lag(file_a: Column, pos_a: Column, file_b: Column, pos_b: Column) -> Column:
    """How far b is behind a: ``files.bytes`` read as one decimal number.

    Null when a file name has no trailing number or the number is zero for a;
    zero when b is level with or ahead of a.
    """
    a, b = file_number(file_a), file_number(file_b)
    files = a - b
    bytes_ = F.when(files != 0, pos_a).otherwise(pos_a - pos_b)
    text = F.concat(
        files.cast("string"), F.lit("."), F.greatest(bytes_, F.lit(0)).cast("bigint").cast("string"))
    lag = F.greatest(text.cast("double"), F.lit(0.0))
    return (
        F.when(a.isNull() | b.isNull() | (a == 0) | (b == 0), F.lit(None).cast("double"))
        .when(pos_a == pos_b, F.lit(0.0)).otherwise(lag)
    )


def fetch_metrics(events: DataFrame, entries: DataFrame, master: DataFrame) -> DataFrame:
    """Per server and minute: entries converted, bytes, MB and lag behind the master.

    ``events`` carry ``logfile`` and give the position. Counted are ``entries``: events of tables
    not listed, statements switched off and rejected events give none.
    """
    at = F.max(F.struct("seq", "logfile", "log_pos")).alias("at")
    moved = events.groupBy("server_id", F.window("ts", WINDOW).alias("w")).agg(at)
    when = F.timestamp_millis("execute_time")
    counts = entries.groupBy("server_id", F.window(when, WINDOW).alias("w")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("event_length").alias("_size"))
    zero = F.lit(0).cast("bigint")
    per_minute = moved.join(counts, ["server_id", "w"], "left").withColumns({
        "fetch_rows": F.coalesce("_n", zero), "fetch_size": F.coalesce("_size", zero)})
    now = master.select(
        "server_id", F.col("logfile").alias("_file"), F.col("pos").alias("_pos"))
    lag = position_lag(F.col("_file"), F.col("_pos"), F.col("at.logfile"), F.col("at.log_pos"))
    # A server whose master is unknown keeps its counts and has no lag.
    return per_minute.join(now, "server_id", "left").select(
        "server_id", F.col("w.start").alias("minute_start"), "fetch_rows", "fetch_size",
        (F.col("fetch_size") / BYTES_PER_MB).alias("fetch_mb"), lag.alias("delay_num"),
    )


def send_metrics(
    packed: DataFrame, entries: DataFrame, size: Column, now_ms: Column,
    send_ms: Column | None = None, width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Per message: rows, bytes, time spent sending, and delay of the latest commit at or before
    its end. Commits come from ``entries``, the log before the second filter."""
    spent = F.lit(0).cast("bigint") if send_ms is None else F.sum(send_ms)
    messages = packed.groupBy("server_id", "message_no").agg(
        F.count(F.lit(1)).alias("send_rows"),
        F.sum(size.cast("bigint")).alias("send_size"),
        spent.alias("send_time"),
        # A commit at a message's end comes before it.
        (F.max("seq") * 2 + 1).alias("_at"),
    )
    commits = entries.filter(F.col("entry_type") == "TRANSACTIONEND").select(
        "server_id", (F.col("seq") * 2).alias("_at"), F.col("execute_time").alias("_commit"))
    both = messages.unionByName(commits, allowMissingColumns=True)
    placed = latest(both, ["server_id"], "_at", {"_last": F.col("_commit")}, width=2 * width)
    return placed.filter(F.col("message_no").isNotNull()).select(
        "server_id", "message_no", "send_rows", "send_size", "send_time",
        (now_ms - F.col("_last")).alias("delay_time"))


def entry_delay(entries: DataFrame, now_ms: Column) -> DataFrame:
    return entries.withColumn("delay_ms", now_ms - F.col("execute_time"))


def over_stock(raw: DataFrame, master: DataFrame) -> DataFrame:
    """Master position minus last event position per server; file names ignored."""
    last = raw.groupBy("server_id").agg(F.max(F.struct("seq", "log_pos")).alias("l"))
    return last.join(master.select("server_id", "pos"), "server_id").select(
        "server_id", (F.col("pos") - F.col("l.log_pos")).alias("over_stock"))


def monitor_messages(
    metrics: DataFrame, job: str, form: str = "online", mark: str = MARK
) -> DataFrame:
    """Envelope JSON for a metrics table with column ``message_id``.

    The content depends on the id; an id of no known kind has an empty content. ``mark`` names
    the field that carries the job.
    """
    have = set(metrics.columns)
    online = {
        FETCH: ["fetch_rows", "fetch_size", "delay_num"],
        SEND: ["send_rows", "send_size", "send_time", "delay_time"],
        EXCEPTION: ["exception"], ADDRESS: ["ip"],
    }
    legacy = {LEGACY_FETCH: ["fetch_rows", "fetch_size"], LEGACY_SEND: online[SEND]}
    content = F.lit("{}")
    for message_id, fields in (online if form == "online" else legacy).items():
        if have.issuperset(fields):
            body = F.to_json(F.struct(*[F.col(f).alias(f.upper()) for f in fields]))
            content = F.when(F.col("message_id") == message_id, body).otherwise(content)
    envelope = F.to_json(F.struct(
        F.col("message_id").cast("int").alias("id"), F.lit(job).alias(mark),
        content.alias("content"),
    ))
    return metrics.withColumn("value", envelope)


def read_monitor_messages(messages: DataFrame, mark: str = MARK) -> DataFrame:
    """Envelope and content fields of JSON monitoring messages."""
    outer = messages.withColumn("_e", F.from_json(
        "value", f"id int, `{mark}` string, content string"))
    inner = outer.withColumn("_c", F.from_json("_e.content", CONTENT))
    fields = [f.split()[0] for f in CONTENT.split(", ")]
    return inner.select(
        *[c for c in messages.columns if c != "value"],
        F.col("_e.id").alias("message_id"), F.col(f"_e.`{mark}`").alias("job"),
        *[F.col(f"_c.{f}").alias(f.lower()) for f in fields],
    )

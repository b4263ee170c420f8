"""Throughput, lag and checkpoints by minute of a live log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import monitor as M

LATE = "10 minutes"


def minutes(events: DataFrame, late: str = LATE) -> DataFrame:
    """Per server and closed minute: entries, bytes, last position and last commit.

    ``events``: a stream with server_id, seq, ts, logfile, logfile_offset, log_pos, event_length,
    entry_type and is_entry (whether the event gave an entry). A minute is final once an event
    ``late`` after its end was seen. Until then late events still count, and events that are sent
    again count once; later ones are left out. State is a key per event of the last ``late`` and a
    row per open minute, whatever the log's length.
    """
    once = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["server_id", "seq"])
    entry = F.col("is_entry")
    commit = F.struct("seq", "logfile", (F.col("logfile_offset") + F.col("event_length")).alias("pos"))
    zero = F.lit(0).cast("bigint")
    return once.groupBy("server_id", F.window("ts", M.WINDOW).alias("w")).agg(
        F.max(F.struct("seq", "logfile", "log_pos")).alias("at"),
        F.count_if(entry).alias("fetch_rows"),
        F.coalesce(F.sum(F.when(entry, F.col("event_length").cast("bigint"))), zero).alias("fetch_size"),
        F.max(F.when(entry & (F.col("entry_type") == "TRANSACTIONEND"), commit)).alias("c"))


def live_metrics(
    events: DataFrame, master: Callable[[], DataFrame], path: str, checkpoint_path: str,
    late: str = LATE, **trigger,
) -> StreamingQuery:
    """Write the closed minutes to ``path`` as they pass, with the lag behind ``master()``
    (server_id, logfile, pos; asked for each micro-batch) and the minute's commit, null without one.

    A micro-batch has a folder of its own, so one that is run twice leaves its rows once.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        now = master().select("server_id", F.col("logfile").alias("_file"), F.col("pos").alias("_pos"))
        lag = M.position_lag(F.col("_file"), F.col("_pos"), F.col("at.logfile"), F.col("at.log_pos"))
        batch.join(now, "server_id", "left").select(
            "server_id", F.col("w.start").alias("minute_start"), "fetch_rows", "fetch_size",
            (F.col("fetch_size") / M.BYTES_PER_MB).alias("fetch_mb"), lag.alias("delay_num"),
            F.col("c.logfile").alias("commit_file"), F.col("c.pos").alias("commit_pos"),
        ).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")

    return (
        minutes(events, late).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )

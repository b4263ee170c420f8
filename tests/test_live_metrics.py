from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidelog.operators import monitor as M
from tidelog.streaming.live_metrics import live_metrics

START = datetime(2024, 5, 1)
SCHEMA = ("server_id long, seq long, ts timestamp, logfile string, logfile_offset long, log_pos long, "
          "event_length long, entry_type string, is_entry boolean")


def event(seq, server=1):
    kind = "TRANSACTIONEND" if seq % 4 == 3 else "ROWDATA"
    return (server, seq, START + timedelta(seconds=7 * seq), f"bin.{seq // 100 + 1:06d}", seq * 50, seq * 50 + 50,
            50 + seq % 5, kind, seq % 6 != 5)


def test_live_minutes_equal_the_batch(spark, tmp_path):
    """The log arrives in four parts; some events come twice, some late but in time. A part whose
    events come after their minute was closed changes nothing."""
    source, out, mark = (str(tmp_path / n) for n in ("source", "out", "mark"))
    everything = [event(s, server) for s in range(400) for server in (1, 2)]
    early = [e for e in everything if e[1] % 50 != 49]
    held_back = [e for e in everything if e[1] % 50 == 49]  # come one part later, at most 6 minutes
    parts = [[e for e in early if e[1] // 40 == k] + [e for e in held_back if e[1] // 40 == k - 1]
             + [e for e in everything if e[1] // 40 == k - 1 and e[1] % 3 == 0] for k in range(11)]
    parts.append([(1, 9999, START, "bin.000001", 0, 50, 50, "ROWDATA", True)])  # far too late
    master = spark.createDataFrame([(1, "bin.000009", 100)], "server_id long, logfile string, pos long")
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        live_metrics(stream, lambda: master, out, mark, availableNow=True).awaitTermination()
    got = spark.read.parquet(out)
    whole = spark.createDataFrame(everything, SCHEMA)
    entries = whole.filter("is_entry").withColumn("execute_time", F.unix_millis("ts"))
    newest = max(e[2] for e in everything)
    closed = F.lit(newest - timedelta(minutes=10))
    want = M.fetch_metrics(whole, entries, master).filter(
        F.col("minute_start") + F.expr("interval 1 minute") <= closed)
    columns = ["server_id", "minute_start", "fetch_rows", "fetch_size", "fetch_mb", "delay_num"]
    rows = sorted(map(tuple, got.select(columns).collect()))
    assert rows == sorted(map(tuple, want.select(columns).collect())) and len(rows) > 60
    ends = {}
    for e in everything:
        if e[7] == "TRANSACTIONEND" and e[8]:
            ends[e[0], e[2].replace(second=0)] = (e[3], e[4] + e[6])
    for r in got.collect():
        assert (r.commit_file, r.commit_pos) == ends.get((r.server_id, r.minute_start), (None, None))

"""Numbering of kept entries and their packing into send messages."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import DEFAULT_WIDTH, merged, positions
from tidelog.sources.shared import written

# The functions below travel inside the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEND_BYTES, SEND_ROWS = 10 * 1024 * 1024, 50_000  # default send limits


def ends_batch() -> Column:
    """An entry after which the batch id advances."""
    return (F.col("entry_type") == "TRANSACTIONEND") | (
        (F.col("entry_type") == "ROWDATA") & F.coalesce(F.col("is_ddl"), F.lit(False))
    )


def assign_batch_ids(
    entries: DataFrame,
    batch0: int | Column = 0,
    in0: int | Column = 0,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Give each kept entry its (batch_id, in_id), continuing from a checkpoint.

    Ids come from running counts over seq ranges, never from a window over one
    batch, so a transaction of any size stays spread out.
    """
    def as_col(v: int | Column) -> Column:
        return v if isinstance(v, Column) else F.lit(v).cast("bigint")

    numbered = positions(entries, ["server_id"], "seq", ends_batch(), width=width)
    first = F.col("marks_before") == 0
    return numbered.withColumns({
        "batch_id": F.col("marks_before") + as_col(batch0),
        "in_id": F.col("since_mark") + F.when(first, as_col(in0)).otherwise(F.lit(0)),
    }).drop("rows_before", "marks_before", "since_mark")


# --- Message packing ---------------------------------------------------------
# A message closes with the entry that brings it to max_bytes or max_rows, so a
# boundary depends on every boundary before it. The log is cut into chunks of
# ``chunk`` >= max_rows entries by dense index. A message spans at most two chunks,
# so all a chunk needs from the past is how many rows of the previous chunk are
# still open: one of at most max_rows values. Each chunk becomes a table
# open rows in -> open rows out, tables of neighbouring chunks are composed level
# by level, and the true value is handed back down. Each task holds one chunk, or
# ``FAN`` such tables, whatever the size of the log.

FAN = 64
_TABLE = "server_id bigint, chunk bigint, open_in bigint, open_out bigint"


def _cuts(sizes: np.ndarray, max_bytes: int, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Running bytes, and for a message starting at i the index just after its end.

    An end beyond the chunk is reported as ``len + 1``: the message is still open.
    """
    n = len(sizes)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    by_bytes = np.searchsorted(total, total[:n] + max_bytes, side="left")
    by_bytes = np.maximum(by_bytes, np.arange(n) + 1)
    end = np.minimum(by_bytes, np.arange(n) + max_rows)
    return total, np.where(end > n, n + 1, end)


def _open_at_end(end: np.ndarray) -> np.ndarray:
    """Rows left open at the chunk end when a message starts at i (0..n)."""
    n = len(end)
    start = np.arange(n + 1)
    jump = np.concatenate([np.where(end > n, start[:n], end), [n]])
    while True:  # pointer doubling: log2(messages) rounds
        further = jump[jump]
        if np.array_equal(further, jump):
            return n - jump
        jump = further


def _first_end(total: np.ndarray, tail_bytes: np.ndarray, tail_rows: np.ndarray,
               max_bytes: int, max_rows: int) -> np.ndarray:
    """Index after the entry closing a message already open with these rows and bytes."""
    n = len(total) - 1
    need = np.searchsorted(total, max_bytes - tail_bytes, side="left")
    need = np.minimum(np.maximum(need, 1), max_rows - tail_rows)
    return np.where(need > n, n + 1, need)


def _chunk_table(max_bytes: int, max_rows: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", kind="stable")
        own = pdf[~pdf["halo"]]
        sizes = own["size"].to_numpy(np.int64)
        tail = pdf[pdf["halo"]]["size"].to_numpy(np.int64)[::-1].cumsum()
        rows = np.arange(1, len(tail) + 1)
        fits = (tail < max_bytes) & (rows < max_rows)
        opens = np.concatenate([[0], rows[fits]]).astype(np.int64)
        held = np.concatenate([[0], tail[fits]]).astype(np.int64)
        total, end = _cuts(sizes, max_bytes, max_rows)
        exits = _open_at_end(end)
        n = len(sizes)
        first = _first_end(total, held, opens, max_bytes, max_rows)
        first = np.where(opens == 0, 0, first)
        out = np.where(first > n, opens + n, exits[np.minimum(first, n)])
        return pd.DataFrame({
            "server_id": np.int64(own["server_id"].iloc[0]), "chunk": own["chunk"].iloc[0],
            "open_in": opens, "open_out": out,
        })
    return build


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """One table for a run of neighbouring chunks."""
    groups = [g for _, g in pdf.sort_values("chunk").groupby("chunk", sort=True)]
    first = groups[0]
    value = first["open_out"].to_numpy()
    for g in groups[1:]:
        g = g.sort_values("open_in")
        value = g["open_out"].to_numpy()[np.searchsorted(g["open_in"].to_numpy(), value)]
    return pd.DataFrame({
        "server_id": pdf["server_id"].iloc[0], "chunk": pdf["_up"].iloc[0],
        "open_in": first["open_in"].to_numpy(), "open_out": value,
    })


def _hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
    """Open rows at the start of each chunk, given those at the start of its run."""
    server, value, found = pdf["server_id"].iloc[0], int(pdf["_start"].iloc[0]), []
    for chunk, g in pdf.sort_values("chunk").groupby("chunk", sort=True):
        found.append((server, chunk, value))
        value = int(g.loc[g["open_in"] == value, "open_out"].iloc[0])
    return pd.DataFrame(found, columns=["server_id", "chunk", "open_in"])


def _assign(max_bytes: int, max_rows: int):
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", kind="stable")
        own, opened = pdf[~pdf["halo"]], int(pdf["open_in"].iloc[0])
        tail = pdf[pdf["halo"]]["size"].to_numpy(np.int64)
        held = np.array([tail[len(tail) - opened:].sum() if opened else 0], dtype=np.int64)
        total, end = _cuts(own["size"].to_numpy(np.int64), max_bytes, max_rows)
        n = len(own)
        starts = np.zeros(n, dtype=np.int64)
        at = 0 if opened == 0 else int(
            _first_end(total, held, np.array([opened]), max_bytes, max_rows)[0])
        while at < n:  # one step per message
            starts[at] = 1
            at = int(end[at])
        return own[["server_id", "seq", "chunk"]].assign(begun=starts.cumsum())
    return place


def _open_rows(rows: DataFrame, chunks: int, max_bytes: int, max_rows: int) -> DataFrame:
    """Rows of the previous chunk still open at the start of each chunk."""
    keys, found = ["server_id", "chunk"], "server_id bigint, chunk bigint, open_in bigint"
    zero = F.lit(0).cast("bigint")
    if chunks == 1:
        return rows.select("server_id", "chunk", zero.alias("open_in")).distinct()
    tables = [rows.groupBy(*keys).applyInPandas(_chunk_table(max_bytes, max_rows), _TABLE)]
    parent = F.call_function("div", F.col("chunk"), F.lit(FAN).cast("bigint"))
    while chunks > FAN:
        run = tables[-1].withColumn("_up", parent)
        tables.append(run.groupBy("server_id", "_up").applyInPandas(_compose, _TABLE))
        chunks = -(-chunks // FAN)
    begin = tables[-1].withColumn("_start", zero)
    starts = begin.groupBy("server_id").applyInPandas(_hand_down, found)
    for table in reversed(tables[:-1]):
        above = starts.select(
            "server_id", F.col("chunk").alias("_up"), F.col("open_in").alias("_start"))
        run = table.withColumn("_up", parent).join(above, ["server_id", "_up"])
        starts = run.groupBy("server_id", "_up").applyInPandas(_hand_down, found)
    return starts


def pack_messages(
    entries: DataFrame,
    size: Column,
    max_bytes: int = SEND_BYTES,
    max_rows: int = SEND_ROWS,
    *,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Add ``message_no`` (0, 1, ...) per server: greedy batches in log order.

    The entry that reaches a limit is the last of its message. Only key, index and
    size pass through Python; the payload columns are joined back by key.
    """
    chunk = max(width, max_rows)
    narrow = entries.select("server_id", "seq", size.cast("bigint").alias("size"))
    numbered = written(
        positions(narrow, ["server_id"], "seq", width=width)
        .select("server_id", "seq", "size", F.col("rows_before").alias("idx")), "numbered")
    top = numbered.agg(F.max("idx")).first()[0] or 0  # one number
    chunks = top // chunk + 1
    wide = F.lit(chunk).cast("bigint")
    own = numbered.withColumns(
        {"chunk": F.call_function("div", F.col("idx"), wide), "halo": F.lit(False)})
    rows = own
    if chunks > 1:  # the tail of each chunk also goes, marked, to the chunk after it
        tail = own.filter(F.pmod("idx", wide) > chunk - max_rows).withColumns(
            {"chunk": F.col("chunk") + 1, "halo": F.lit(True)})
        last = own.groupBy("server_id").agg(F.max("chunk").alias("_last"))
        tail = tail.join(last, "server_id").filter(F.col("chunk") <= F.col("_last")).drop("_last")
        rows = own.unionByName(tail)
    keys = ["server_id", "chunk"]
    starts = _open_rows(rows, chunks, max_bytes, max_rows)
    placed = rows.join(starts, keys).groupBy(*keys).applyInPandas(
        _assign(max_bytes, max_rows),
        "server_id bigint, seq bigint, chunk bigint, begun bigint",
    )
    if chunks == 1:
        number = placed.select("server_id", "seq", (F.col("begun") - 1).alias("message_no"))
    else:
        placed = written(placed, "placed")
        before = Window.partitionBy("server_id").orderBy("chunk").rowsBetween(
            Window.unboundedPreceding, -1)
        earlier = placed.groupBy(*keys).agg(F.max("begun").alias("_n")).select(
            *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
        number = placed.join(earlier, keys).select(
            "server_id", "seq", (F.col("_earlier") + F.col("begun") - 1).alias("message_no"))
    return merged(entries, number, ["server_id", "seq"])


def message_summary(packed: DataFrame, size: Column) -> DataFrame:
    """Rows, bytes and seq range of each message."""
    return packed.groupBy("server_id", "message_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(size.cast("bigint")).alias("n_bytes"),
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
    )

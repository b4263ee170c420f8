"""Exact deduplication against an index of earlier digests (minimal perfect hash).

Earlier distinct digests are dealt into buckets by their own leading bits. In each bucket
hash-and-displace gives every digest its own slot, with no free slots; a slot holds the full
digest and the locator of the best row that has it. A new digest is looked up by computing its
slot and comparing all of its bytes; digests that are not members form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import BLANKS, join_groups, keep_rows
from tidelog.sources.shared import written

#: Digests a bucket of the index holds on average.
BUCKET = 4096
#: Digests that share a displacement on average.
LOAD = 4

_BEST = "group_size bigint, n bigint, doc_id bigint, row bigint"
INDEX = "bucket bigint, pilots binary, digests binary, group_size array<bigint>, " \
    "n array<bigint>, doc_id array<bigint>, row array<bigint>"
GROUPS = f"digest binary, {_BEST}"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, tag (hash of the text), n (its code points), digest: SHA-256 without ASCII blanks.

    A null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"),
        F.length(text).cast("long").alias("n"),
        F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("digest"))


def best_rows(rows: DataFrame) -> DataFrame:
    """Per digest: number of rows, and the row with the largest n, then smallest doc_id (null
    last), then smallest row number."""
    order = F.struct(
        -F.col("n"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    return rows.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.min(order).alias("_o")).select(
        "digest", "group_size", (-F.col("_o.col1")).alias("n"), F.col("_o.doc_id").alias("doc_id"),
        F.col("_o.row").alias("row"))


def _hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two values of each 32-byte digest, from bytes that the bucket does not use."""
    words = keys.view("<u8").reshape(-1, 4)
    return words[:, 1], words[:, 2]


def _slots(mixed: np.ndarray, pilot, size: int) -> np.ndarray:
    x = mixed ^ (np.asarray(pilot, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def place(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements and the slot of each of the distinct 32-byte ``keys`` (n x 32 bytes).

    The slots are 0..n-1, each taken once. Groups of keys with one displacement are placed
    largest first, each by the first displacement that hits free slots only.
    """
    n = len(keys)
    first, second = _hashes(keys)
    parts = max(1, -(-n // LOAD))
    part = (first % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    pilots = np.zeros(parts, np.uint32)
    slots = np.empty(n, np.int64)
    free = np.ones(n, bool)
    for p in np.argsort(-np.diff(bounds), kind="stable"):
        own = order[bounds[p]:bounds[p + 1]]
        if not len(own):
            break
        start = 0
        while True:
            tries = np.arange(start, start + 512, dtype=np.uint64)
            at = _slots(second[own][None, :], tries[:, None], n)
            good = free[at].all(axis=1)
            if len(own) > 1:
                ranked = np.sort(at, axis=1)
                good &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                pilots[p], slots[own] = start + k, at[k]
                free[at[k]] = False
                break
            start += 512
    return pilots, slots


def find(keys: np.ndarray, pilots: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The slot of each key, or -1 where the digest stored in its slot is another one."""
    if not len(table):
        return np.full(len(keys), -1)
    first, second = _hashes(keys)
    at = _slots(second, pilots[(first % np.uint64(len(pilots))).astype(np.int64)], len(table))
    return np.where((table[at] == keys).all(axis=1), at, -1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, 32)


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    keys = _matrix(frame["digest"])
    pilots, slots = place(keys)
    by_slot = np.empty(len(slots), np.int64)
    by_slot[slots] = np.arange(len(slots))
    frame = frame.iloc[by_slot]
    return pd.DataFrame([{
        "bucket": frame["bucket"].iat[0], "pilots": pilots.tobytes(),
        "digests": keys[by_slot].tobytes(),
        **{c: [None if pd.isna(v) else int(v) for v in frame[c]]
           for c in ("group_size", "n", "doc_id", "row")}}])


def build_index(best: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: displacements, and by slot the digest and its locator."""
    dealt = best.withColumn("bucket", _bucket(buckets))
    return dealt.groupBy("bucket").applyInPandas(_build, INDEX)


def _bucket(buckets: int):
    return F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % buckets


def _order(n, doc_id, row) -> tuple:
    return -int(n), pd.isna(doc_id), 0 if pd.isna(doc_id) else int(doc_id), int(row)


def _look_up(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    names = ["digest", "group_size", "n", "doc_id", "row"]
    if not len(index):
        return new[names]
    slot = index.iloc[0]
    table = np.frombuffer(slot["digests"], np.uint8).reshape(-1, 32)
    held = pd.DataFrame({
        "digest": [x.tobytes() for x in table],
        **{c: pd.array([None if pd.isna(v) else int(v) for v in slot[c]], "Int64")
           for c in names[1:]}})
    if not len(new):
        return held
    at = find(_matrix(new["digest"]), np.frombuffer(slot["pilots"], np.uint32), table)
    fresh = new[at < 0]
    for k, row in zip(at[at >= 0], new[at >= 0].itertuples(index=False)):
        held.loc[k, "group_size"] += row.group_size
        mine = held.loc[k, ["n", "doc_id", "row"]]
        if _order(row.n, row.doc_id, row.row) < _order(*mine):
            held.loc[k, ["n", "doc_id", "row"]] = [
                row.n, pd.NA if pd.isna(row.doc_id) else int(row.doc_id), row.row]
    for c in names[1:]:
        fresh = fresh.assign(**{c: fresh[c].astype("Int64")})
    return pd.concat([held, fresh[names]])


def exact_duplicates(rows: DataFrame, earlier) -> DataFrame:
    """``rows`` (doc_id, n, digest, row; a stored table) with keep_id, group_size and kept.

    ``earlier`` is a condition on the rows: those it names are the history that the index is
    built from, the others are looked up. The result does not depend on the division. Of equal
    digests the row with the largest n stays, then the smallest doc_id (null last), then the
    smallest row number, so that one row of repeated rows stays.
    """
    total = rows.count()
    buckets = max(1, -(-total // BUCKET))
    index = build_index(best_rows(rows.filter(earlier)), buckets)
    new = best_rows(rows.filter(~earlier)).withColumn("bucket", _bucket(buckets))
    groups = new.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        _look_up, GROUPS).select(
        "digest", "group_size", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    groups = written(groups, "exact_groups")
    return join_groups(rows, groups, ["digest"], "group_size", total).withColumn(
        "kept", F.col("row") == F.col("keep_row"))


def _judged(docs: DataFrame) -> DataFrame:
    """Every row's digest and verdict. Half of the documents, by a checksum of the id, are taken
    as history."""
    rows = digests(docs).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "exact_digests")
    earlier = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return exact_duplicates(rows, earlier)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Contract of op3, one row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are one group; a null doc_id sorts last; of repeated rows one is kept.
    An empty table gives an empty result.
    """
    return _judged(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns."""
    judged = written(_judged(docs), "exact_judged")
    many = judged.groupBy("doc_id", "tag").agg(
        F.max("kept").alias("kept"), F.count("*").alias("copies"))
    return keep_rows(docs, written(many.filter("kept").select(
        F.col("doc_id").alias("doc"), "tag", "copies", F.lit(True).alias("one")), "exact_kept"))


ORACLE = r"""
with d as (select doc_id, length(coalesce(text, '')) as n,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h from documents),
r as (select *, row_number() over (partition by h order by n desc, doc_id) as k,
  first_value(doc_id) over (partition by h order by n desc, doc_id) as keep_id,
  count(*) over (partition by h) as group_size from d)
select doc_id, keep_id, group_size, k = 1 as kept, h as text_sha256 from r
"""

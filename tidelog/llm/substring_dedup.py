"""Substring deduplication over windows of words, by super-k-mers.

The minimiser of a window is the least hash of its GRAM-word runs. Consecutive windows of a
document that share their minimiser overlap in all but a few words, so they travel as one packed
string, a super-k-mer, to the minimiser's bucket. There the windows of all strings are sorted by
hash and, in a hash, by document; equal neighbours are compared byte by byte, and every window
that also starts in a smaller document is reported. Reports meet the texts once more.

A shuffle partition holds SUB buckets, which are looked at one after another: a task sends few
large, well compressed packets, whatever the number of buckets, and memory is that of one bucket.
The texts travel to their reports in packets of the same kind, equal rows of a task once.

Skew: a minimiser of very many windows is found beforehand by a count over all documents, whose
counters grow with the buckets, so that hot means a quarter of a bucket at any size;
its windows travel one by one, each to the bucket of its own hash. Of equal strings in a chunk of
documents only those of the smallest document travel, the others are already decided; a task also
remembers the windows that travelled alone, so a bucket gets one of them about once per task, not
once per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import partitions_for
from tidelog.llm.hashing import mix, run_hashes, span_hashes, word_spans
from tidelog.sources.shared import written

WINDOW = 13
#: Words of the runs that minimisers are chosen from.
GRAM = 3
#: Counters of the count of minimisers: for each bucket, at least, and at most.
PER_BUCKET, LEAST_COUNTERS, MOST_COUNTERS = 16, 1 << 16, 1 << 22
#: Bytes of text handled together in a task, of packed strings in a bucket, and of text whose
#: packets are sent together.
CHUNK, BUCKET, PACKET = 4 << 20, 6 << 20, 16 << 20
#: Buckets of a shuffle partition, and bytes of text in one when texts meet their reports.
SUB, TEXTS = 10, 48 << 20
#: Compression of packets.
LEVEL = 3
#: Lone windows that a task remembers; beyond, it starts anew and more of them travel.
REMEMBERED = 200_000
#: Stands for a null doc_id, which is larger than all others.
LAST = np.iinfo(np.int64).max


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:len(x) - step], x[step:])
        done += step
    return x


class Words:
    """The words of several texts, joined by one blank, with their hashes."""

    def __init__(self, texts: list[str]) -> None:
        each = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        self.sizes = np.array([len(w) for w in each], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        self.buffer = b" ".join([w for words in each for w in words])
        self.starts, self.ends = word_spans(self.buffer)
        self.hashes = span_hashes(self.buffer, self.starts, self.ends)

    def windows(self, size: int) -> np.ndarray:
        """First words of the windows that lie in one text."""
        fit = np.maximum(self.sizes - size + 1, 0)
        before = np.concatenate(([0], np.cumsum(fit)))[:-1]
        return np.arange(fit.sum()) + np.repeat(self.first[:-1] - before, fit)

    def minimisers(self, at: np.ndarray, size: int, gram: int) -> np.ndarray:
        return _least(run_hashes(self.hashes, gram), size - gram + 1)[at] if len(at) else at


def _runs(at: np.ndarray, low: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Where super-k-mers begin among the windows."""
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (low[1:] != low[:-1]) | alone[1:] | alone[:-1]
    return np.flatnonzero(new)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """doc, tag and text lists of about CHUNK bytes."""
    docs: list = []
    tags: list = []
    texts: list = []
    size = 0
    for batch in batches:
        for d, g, t in zip(*(batch.column(k).to_pylist() for k in range(3))):
            docs.append(d)
            tags.append(g)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= CHUNK:
                yield docs, tags, texts
                docs, tags, texts, size = [], [], [], 0
        # A batch is the scope; what is left of it is not kept for the next one.
        if docs:
            yield docs, tags, texts
            docs, tags, texts, size = [], [], [], 0


def counters_for(buckets: int) -> int:
    """Counters, a power of two, for this many buckets."""
    wish = 1 << (PER_BUCKET * buckets - 1).bit_length()
    return max(LEAST_COUNTERS, min(MOST_COUNTERS, wish))


def _count(window: int, gram: int, counters: int):
    """Per task: super-k-mers per counter."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for _, _, texts in _chunks(batches):
            words = Words(texts)
            at = words.windows(window)
            low = words.minimisers(at, window, gram)
            low = low[_runs(at, low, np.zeros(len(at), bool))] if len(at) else low
            total += np.bincount((low % np.uint64(counters)).astype(np.int64), minlength=counters)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(total[slot], pa.int64())], names=["slot", "n"])
    return over


#: Of the arrays of a bucket: doc, tag, start, windows; then the same of the decided ones.
_KINDS = [np.int64, np.int64, np.int32, np.int32] * 2


def _pack(segments: list[tuple[int, list[list[np.ndarray]], list[bytes]]]) -> bytes:
    """A packet: per bucket its number in the partition, its arrays and its strings."""
    body = []
    for sub, pieces, strings in segments:
        arrays = [np.concatenate(x) for x in zip(*pieces)]
        text = b" ".join(strings)
        body.append(np.array([sub, len(text), *map(len, arrays)], np.int64).tobytes())
        body += [a.tobytes() for a in arrays]
        body.append(text)
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(body))


def _unpack(blob: bytes) -> Iterator[tuple[int, list[np.ndarray], bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    at = 0
    while at < len(data):
        sub, size, *counts = np.frombuffer(data, np.int64, 2 + len(_KINDS), at).tolist()
        at += 8 * (2 + len(_KINDS))
        arrays = []
        for n, kind in zip(counts, _KINDS):
            arrays.append(np.frombuffer(data, kind, n, at))
            at += arrays[-1].nbytes
        yield sub, arrays, data[at:at + size]
        at += size


def _send(window: int, gram: int, parts: int, hot: np.ndarray, counters: int):
    """Super-k-mers, packed per shuffle partition, by buckets."""
    is_hot = np.zeros(counters, bool)
    is_hot[hot] = True

    def packets(held: dict[int, tuple[list, list]]) -> pa.RecordBatch:
        """What is held for every bucket, as a packet per partition."""
        found: dict[int, list] = {}
        for bucket in sorted(held):
            found.setdefault(bucket // SUB, []).append((bucket % SUB, *held[bucket]))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()),
             pa.array([_pack(x) for x in found.values()], pa.binary())], names=["part", "blob"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent_before: dict[bytes, int] = {}
        held: dict[int, tuple[list, list]] = {}
        size = 0
        for docs, tags, texts in _chunks(batches):
            size += sum(map(len, texts))
            words = Words(texts)
            at = words.windows(window)
            if not len(at):
                continue
            low = words.minimisers(at, window, gram)
            alone = is_hot[(low % np.uint64(counters)).astype(np.int64)]
            begin = _runs(at, low, alone)
            count = np.diff(np.append(begin, len(at)))
            first = at[begin]
            route = np.where(alone[begin], run_hashes(words.hashes, window)[first], low[begin])
            last = first + count + window - 2
            buffer = words.buffer
            strings = [buffer[a:b] for a, b in zip(
                words.starts[first].tolist(), words.ends[last].tolist())]
            row = np.searchsorted(words.first, first, "right") - 1
            ids = np.array([LAST if d is None else d for d in docs], np.int64)
            doc, tag = ids[row], np.array(tags, np.int64)[row]
            start = (first - words.first[row]).astype(np.int32)
            count = count.astype(np.int32)
            smallest: dict[bytes, int] = {}
            for s, d in zip(strings, doc.tolist()):
                if d < smallest.setdefault(s, d):
                    smallest[s] = d
            for k in np.flatnonzero(alone[begin]).tolist():
                s = strings[k]
                least = sent_before.get(s)
                if least is None or smallest[s] < least:
                    sent_before[s] = smallest[s]
                else:
                    smallest[s] = least
            if len(sent_before) > REMEMBERED:
                sent_before.clear()
            decided = doc > np.fromiter(map(smallest.__getitem__, strings), np.int64, len(strings))
            bucket = (mix(route) % np.uint64(parts * SUB)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for own in np.split(order, cuts):
                sent, done = own[~decided[own]], own[decided[own]]
                pieces, kept = held.setdefault(int(bucket[own[0]]), ([], []))
                pieces.append([x[k] for k in (sent, done) for x in (doc, tag, start, count)])
                kept += [strings[k] for k in sent.tolist()]
            if size >= PACKET:
                yield packets(held)
                held, size = {}, 0
        if held:
            yield packets(held)
    return over


def _repeated(buffer: bytes, begin: np.ndarray, end: np.ndarray, h: np.ndarray,
              doc: np.ndarray) -> np.ndarray:
    """Windows ``buffer[begin:end]`` that also occur with a smaller document."""
    order = np.lexsort((doc, h))
    sh, sd = h[order], doc[order]
    head = np.ones(len(order), bool)
    head[1:] = sh[1:] != sh[:-1]
    leader = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    apart: set[int] = set()
    a, b = begin[order], end[order]
    candidates = np.flatnonzero(~head)
    lead = leader[candidates]
    equal = [buffer[p:q] == buffer[r:s] for p, q, r, s in zip(
        a[candidates].tolist(), b[candidates].tolist(), a[lead].tolist(), b[lead].tolist())]
    equal = np.array(equal, bool)
    out[order[candidates]] = equal & (sd[candidates] > sd[lead])
    for k in lead[~equal].tolist():  # two texts with one hash: decide these by their bytes
        apart.add(k)
    for k in apart:
        stop = k + 1
        while stop < len(order) and not head[stop]:
            stop += 1
        least: dict[bytes, int] = {}
        for j in range(k, stop):
            out[order[j]] = least.setdefault(buffer[a[j]:b[j]], int(sd[j])) < sd[j]
    return out


def _found(window: int, found: list[tuple[list[np.ndarray], bytes]]) -> list[list[np.ndarray]]:
    """One bucket: the runs of windows that a smaller document has, in sets of arrays."""
    doc, tag, start, count, *decided = (np.concatenate(x) for x in zip(*(a for a, _ in found)))
    out = [decided]
    if not len(doc):
        return out
    buffer = b" ".join([text for _, text in found if text])
    starts, ends = word_spans(buffer)
    h = run_hashes(span_hashes(buffer, starts, ends), window)
    sizes = count.astype(np.int64)
    word = np.concatenate(([0], np.cumsum(sizes + window - 1)))[:-1]
    before = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    piece = np.repeat(np.arange(len(doc)), sizes)
    inside = np.arange(len(piece)) - before[piece]
    at = word[piece] + inside
    again = _repeated(buffer, starts[at], ends[at + window - 1], h[at], doc[piece])
    hit = np.flatnonzero(again)
    if len(hit):
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (np.diff(piece[hit]) != 0)
        first = np.flatnonzero(new)
        k = hit[first]
        out.append([doc[piece[k]], tag[piece[k]], (start[piece[k]] + inside[k]).astype(np.int32),
                    np.diff(np.append(first, len(hit))).astype(np.int32)])
    return out


def _receive(window: int):
    """One partition: runs of windows that a smaller document has, as doc, tag, start, n."""
    def over(table: pa.Table) -> pa.Table:
        buckets: dict[int, list] = {}
        for blob in table.column("blob"):
            for sub, arrays, text in _unpack(blob.as_py()):
                buckets.setdefault(sub, []).append((arrays, text))
        out = [[np.empty(0, k) for k in _KINDS[:4]]]
        while buckets:
            out += _found(window, buckets.popitem()[1])
        return pa.table({n: np.concatenate([o[k] for o in out])
                         for k, n in enumerate(("doc", "tag", "start", "n"))})
    return over


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc, tag, start, n: runs of n windows, from word ``start`` of a document on, that also
    start in a document with a smaller doc_id. tag is the text's hash; a null doc_id is LAST."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("tag"),
                       "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Packed strings hold about three times the text.
    parts = max(least, -(-3 * size // (BUCKET * SUB)))
    counters = counters_for(parts * SUB)
    counts = rows.mapInArrow(_count(window, gram, counters), "slot int, n bigint").groupBy("slot").agg(
        F.sum("n").alias("n"))
    counts = written(counts, "minimiser_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Fewer than 4 counters a bucket can hold more than this.
    hot = np.array([r.slot for r in counts.filter(F.col("n") > max(
        1000, total // (4 * parts * SUB))).select("slot").collect()], np.int64)
    sent = rows.mapInArrow(_send(window, gram, parts, hot, counters), "part int, blob binary")
    return sent.groupBy("part").applyInArrow(
        _receive(window), "doc bigint, tag bigint, start int, n int")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed per partition: doc, whether it is null, tag, copies and bytes of each."""
    held: dict[int, dict[tuple, int]] = {}
    size = 0

    def packets() -> pa.RecordBatch:
        blobs = []
        for rows in held.values():
            docs, tags, texts = zip(*rows)
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            blobs.append(zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([
                np.array([len(rows)], np.int64).tobytes(),
                np.array([d or 0 for d in docs], np.int64).tobytes(),
                np.array([d is None for d in docs], np.int64).tobytes(),
                np.array(tags, np.int64).tobytes(), np.array(list(rows.values()), np.int64).tobytes(),
                np.array(list(map(len, data)), np.int64).tobytes(), *data])))
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(
            blobs, pa.binary())], names=["part", "blob"])

    for batch in batches:
        for part, doc, tag, text in zip(*(batch.column(c).to_pylist() for c in (
                "part", "doc", "tag", "text"))):
            rows = held.setdefault(part, {})
            key = (doc, tag, text or "")
            # A row met again is counted.
            size += 0 if key in rows else len(text or "")
            rows[key] = rows.get(key, 0) + 1
            if size >= PACKET:
                yield packets()
                held, size = {}, 0
    if held:
        yield packets()


def _remove(window: int):
    """Texts of one partition and their runs to the contract's rows."""
    def over(texts: pa.Table, reports: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[int]] = {}
        for k, at in enumerate(zip(reports.column("doc").to_pylist(), reports.column("tag").to_pylist())):
            found.setdefault(at, []).append(k)
        start, count = (reports.column(c).to_numpy().astype(np.int64) for c in ("start", "n"))
        out = []
        for blob in texts.column("blob"):
            data = zstandard.ZstdDecompressor().decompress(blob.as_py())
            n = int(np.frombuffer(data, np.int64, 1)[0])
            docs, null, tags, copies, sizes = np.frombuffer(data, np.int64, 5 * n, 8).reshape(5, n).tolist()
            at = 8 + 40 * n
            for doc, is_null, tag, times, size in zip(docs, null, tags, copies, sizes):
                words = data[at:at + size].split()
                at += size
                total = len(words)
                runs = found.get((int(LAST) if is_null else doc, tag))
                if runs:
                    edge = np.zeros(total + 1, np.int64)
                    np.add.at(edge, start[runs], 1)
                    np.add.at(edge, start[runs] + count[runs] + window - 1, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge)[:total] == 0).tolist()]
                out += [(None if is_null else doc, total, total - len(words),
                         sha256(b" ".join(words)).hexdigest())] * times
        columns = list(zip(*out)) if out else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(
            columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return over


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Contract of op1, one row per document: doc_id, n_words, n_removed, kept_sha256.

    Null, empty and short texts have no windows and lose nothing. Rows with one doc_id do not
    affect each other; a null doc_id is larger than all others; an empty table gives an empty
    result.
    """
    reports = written(repeated_windows(docs, window, gram), "repeated_windows")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions_for(docs, size, TEXTS)
    part = F.pmod(F.xxhash64("key", "tag"), F.lit(parts)).cast("int").alias("part")
    doc = F.col("doc_id").cast("long")
    rows = docs.select(doc.alias("doc"), F.coalesce(doc, F.lit(int(LAST))).alias("key"),
                       F.xxhash64("text").alias("tag"), "text")
    sent = rows.select(part, "doc", "tag", "text").mapInArrow(_texts, "part int, blob binary")
    runs = reports.withColumnRenamed("doc", "key").select(part, F.col("key").alias("doc"), "tag", "start", "n")
    return sent.groupBy("part").cogroup(runs.groupBy("part")).applyInArrow(
        _remove(window), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


ORACLE = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(doc_id, {LAST}) as o,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select r, o, i, w[i:i + {WINDOW - 1}] as g from (
  select r, o, w, unnest(range(1, len(w) - {WINDOW} + 2)) as i from d where len(w) >= {WINDOW})),
hit as (select r, i from (select r, i, o, min(o) over (partition by g) as least from g) where least < o),
gone as (select distinct r, p from (select r, unnest(range(i, i + {WINDOW})) as p from hit)),
e as (select r, w[p] as word, p from (select r, w, unnest(range(1, len(w) + 1)) as p from d)),
kept as (select r, string_agg(word, ' ' order by p) as text, count(*) as n
  from e anti join gone using (r, p) group by r)
select doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256 from d left join kept using (r)
"""

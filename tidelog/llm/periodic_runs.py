"""Periodic run detection by an online sparse diagonal DP.

A run of period q is a stretch whose words equal those q before; q is its smallest period, it has
at least max(LEAST, TIMES * q) words, and no neighbour extends it. On the diagonal of lag d the DP
counts, word by word, how many neighbouring words have an earlier occurrence d before; a diagonal
that ends after enough words emits its stretch. The diagonal is sparse: a run of TIMES periods
matches on (TIMES - 1) * d neighbouring words, so among the words whose number d divides it matches
on TIMES - 1 in a row, and only those are stepped: n / d words for lag d, n * ln(n) in all, however
often a word occurs. Only where that many meet in a row are the words between compared, and the
stretch's match length is exact. Lags rise; a chain inside a run already emitted whose period
divides the lag is the same run again and is not followed.

Documents of a chunk lie in one array of word codes, of their own for each document, so that no match
crosses documents; those too short for a lag are at its end and are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidelog.llm.crc import CRC_CTE, crc32_sql

#: Least words of a run, and least periods in it.
LEAST, TIMES = 6, 4
#: Bytes of text handled together in a task.
CHUNK = 4 << 20
#: Words of a chain looked at before it is followed whole, as shares of its first two periods.
_SHARES = (0.5, 0.25, 0.75, 1.5, 1.25, 0.125, 1.875, 0.625)


def plant(words: list, doc: int | None) -> list:
    """The contract's words: a tenth of the documents, by checksum, end in a repeated stretch."""
    n = len(words)
    if not n or doc is None:
        return words
    h = crc32(str(doc).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * math.ceil((n - a) / p))[:n - a]


def _stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and length of the stretches of at least ``least`` true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    long = sizes >= least
    return list(zip(starts[long].tolist(), sizes[long].tolist()))


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length, period of every run in texts that lie one after another.

    ``sizes`` are the texts' words, none more than the one before; no code is in two texts.
    """
    found: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()
    # Of the last emitted run over a word: its period and end.
    over = np.zeros(len(codes), np.int32)
    until = np.zeros(len(codes), np.int64)
    ends = np.cumsum(sizes)
    for lag in range(1, int(sizes[0]) // TIMES + 1 if len(sizes) else 0):
        texts = int(np.searchsorted(-sizes, -TIMES * lag, "right"))
        n = int(ends[texts - 1])
        word = codes[:n]
        # Step k compares word (k + 1) * lag with the one a lag before.
        step = word[lag::lag] == word[:-lag:lag]
        if len(step) < TIMES - 1:
            continue
        enough = step[TIMES - 2:].copy()
        for k in range(TIMES - 2):
            enough &= step[k:len(step) - (TIMES - 2 - k)]
        chain = np.flatnonzero(enough)
        if not len(chain):
            continue
        # What is not yet emitted under a period that divides the lag.
        first = (chain + 1) * lag
        known = (over[first] > 0) & (lag % np.maximum(over[first], 1) == 0) & (
            over[first - lag] == over[first]) & (until[first] == until[first - lag]) & (
            first + (TIMES - 2) * lag < until[first])
        chain, first = chain[~known], first[~known]
        for share in _SHARES if lag > 1 else ():
            at = first + int(share * lag)
            good = word[at] == word[at - lag]
            chain, first = chain[good], first[good]
        if not len(chain):
            continue
        least = max(LEAST - lag, (TIMES - 1) * lag)
        group = np.flatnonzero(np.append(True, np.diff(chain) > TIMES - 1))
        last = chain[np.append(group[1:], len(chain)) - 1] + TIMES - 1
        done = -1
        for a, b in zip(chain[group].tolist(), last.tolist()):
            if a < done:
                continue
            # The matches around steps a to b, out to the nearest ones that do not match.
            while a > 0 and step[a - 1]:
                a -= 1
            while b < len(step) and step[b]:
                b += 1
            done = b
            low, high = max(lag, a * lag + 1), min(n, (b + 1) * lag)
            same = word[low:high] == word[low - lag:high - lag]
            for start, matched in _stretches(same, least):
                run = (low + start - lag, matched + lag)
                if run in seen:
                    continue
                seen.add(run)
                found.append((*run, lag))
                over[run[0]:run[0] + run[1]] = lag
                until[run[0]:run[0] + run[1]] = run[0] + run[1]
    out = np.array(sorted(found), np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _chunk(docs: list, texts: list[str | None], plan) -> list[tuple]:
    """The contract's rows, without doc_id, of a chunk's documents."""
    words, codes, sizes = [], [], []
    for doc, text in zip(docs, texts):
        own = plan((text or "").encode("utf-8", "surrogatepass").split(), doc)
        number = {w: k for k, w in enumerate(dict.fromkeys(own))}
        words.append(own)
        codes.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
        sizes.append(len(own))
    order = np.argsort(-np.array(sizes), kind="stable")
    distinct = np.array([int(c.max()) + 1 if len(c) else 0 for c in codes], np.int64)
    base = np.concatenate(([0], np.cumsum(distinct)))
    longest_first = np.array(sizes, np.int64)[order]
    joined = np.concatenate([codes[k] + base[k] for k in order]) if docs else np.empty(0, np.int64)
    start, length, period = find_runs(joined, longest_first)
    first = np.concatenate(([0], np.cumsum(longest_first)))
    cut = np.searchsorted(start, first)
    rows: list[tuple] = [()] * len(docs)
    for place, k in enumerate(order.tolist()):
        i, j = cut[place], cut[place + 1]
        own = words[k]
        if i == j:
            rows[k] = (0, None, None, None, None, sha256(b"").hexdigest(),
                       sha256(b" ".join(own)).hexdigest())
            continue
        s, n, q = start[i:j] - first[place], length[i:j], period[i:j]
        best = np.lexsort((q, s, -n))[0]
        edge = np.zeros(len(own) + 1, np.int64)
        np.add.at(edge, s + q, 1)
        np.add.at(edge, s + n, -1)
        kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s.tolist(), n.tolist(), q.tolist()))
        rows[k] = (int(j - i), int(s[best]), int(n[best]), int(q[best]),
                   int(1000 * n[best] // q[best]), sha256(listed.encode()).hexdigest(),
                   sha256(b" ".join([own[w] for w in kept])).hexdigest())
    return rows


_COLUMNS = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
            ("period", pa.int64()), ("exponent_milli", pa.int64()),
            ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def _over(plan):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows: list[tuple] = []
            begin = size = 0
            for k, text in enumerate(texts):
                size += len(text or "")
                if size >= CHUNK or k + 1 == len(texts):
                    rows += _chunk(docs[begin:k + 1], texts[begin:k + 1], plan)
                    begin, size = k + 1, 0
            values = list(zip(*rows)) if rows else [()] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, (_, t) in zip(values, _COLUMNS))],
                names=["doc_id", *(n for n, _ in _COLUMNS)])
    return over


def collapse_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Contract of op12, one row per document: doc_id, n_runs, start, length, period,
    exponent_milli, runs_sha256, collapsed_sha256. ``planted`` alters words as the contract says.

    Null and empty texts have no words and no runs; a null doc_id is never altered; repeated rows
    are rows of their own; an empty table gives an empty result.
    """
    plan = plant if planted else (lambda words, doc: words)
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        _over(plan), "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
        "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")


# Words whose number a lag divides, three matches in a row, then every word around them.
ORACLE = rf"""
with {CRC_CTE},
d as (select row_number() over () as r, doc_id, {crc32_sql("coalesce(doc_id::varchar, 'x')")} as h,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents, crc),
g as (select r, doc_id, w, len(w) as n, doc_id is not null and len(w) > 0 and h % 10 = 0 as planted,
  h // 10 as g from d),
p as (select *, case when planted then g % n else n end as a from g),
q as (select *, 1 + (n - a) // (3 + g % 8) as p from p),
t as materialized (select r, i, w from (
  select r, i, w[1 + case when i >= a then a + (i - a) % p else i end] as w
  from (select *, unnest(range(n)) as i from q))),
lags as (select r, n, unnest(range(1, n // {TIMES} + 1)) as d from q),
steps as (select r, d, unnest(range(1, (n - 1) // d + 1)) as k from lags),
met as (select s.r, s.d, s.k from steps s join t x on x.r = s.r and x.i = s.k * s.d
  join t y on y.r = s.r and y.i = (s.k - 1) * s.d where x.w = y.w),
chains as (select r, d, min(k) as k1, max(k) as k2 from (
  select *, k - row_number() over (partition by r, d order by k) as z from met)
  group by r, d, z having count(*) >= {TIMES - 1}),
near as (select r, d, unnest(range(greatest(d, (k1 - 1) * d + 1), (k2 + 1) * d)) as i from chains),
m as (select s.r, s.d, s.i from near s join t x on x.r = s.r and x.i = s.i
  join t y on y.r = s.r and y.i = s.i - s.d where x.w = y.w),
s as (select r, d, min(i) - d as start, count(*) + d as length from (
  select *, i - row_number() over (partition by r, d order by i) as k from m)
  group by r, d, k having count(*) >= greatest({LEAST} - d, {TIMES - 1} * d)),
u as (select r, start, length, min(d) as period from s group by r, start, length),
o as (select r, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period
  || chr(10), '' order by start, period)) as runs_sha256,
  max_by({{'s': start, 'n': length, 'q': period}}, {{'n': length, 's': -start, 'q': -period}}) as b
  from u group by r),
gone as (select distinct r, unnest(range(start + period, start + length)) as i from u),
kept as (select r, string_agg(w, ' ' order by i) as text from t anti join gone using (r, i) group by r)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, b.s::bigint as start, b.n::bigint as length,
  b.q::bigint as period, (1000 * b.n // b.q)::bigint as exponent_milli,
  coalesce(runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from d left join o using (r) left join kept using (r)
"""

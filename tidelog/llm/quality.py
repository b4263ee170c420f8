"""Quality rules: counted rules, and a log-likelihood ratio over hashed n-grams.

Texts are cut into pieces (runs of capitals, of digits, of ASCII punctuation, of all else) and
every piece and pair of neighbouring pieces is hashed to a bucket. Two multinomials over the
buckets are counted, add-one smoothed: the raw corpus, which is every document, and the trusted
target, which is every document labelled good. A document's score is the mean over its n-grams of
ln(target / raw), so its length plays no part; at or above CUT it is kept. Nothing is drawn at
random: weights are rounded to 1/SCALE and summed as integers, so a document's verdict does not
depend on the order of the rows.

All of it is built-in expressions. The n-grams are exploded and meet the bucket weights by a
broadcast, whose size the number of buckets bounds; partial sums leave a task as one row per
document, whatever the length of the texts or the skew of their keys.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.crc import CRC_CTE, crc32_sql
from tidelog.sources.shared import written

#: Words of a window whose repeats are counted, and the base rules' limits.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Powers of two between which the number of buckets lies, and text bytes for one bucket.
SMALLEST, LARGEST, BYTES_PER_BUCKET = 12, 18, 1 << 12
#: Weights are kept as whole numbers of 1/SCALE nats.
SCALE = 1 << 16
#: Least mean weight, in nats, of a document that is kept.
CUT = -0.125
#: Trusted ids up to this number are broadcast (16 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 4_000_000

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = "[#*$%&|<>]"
_PIECE = (r"[a-z\x{80}-\x{10FFFF}]+|[A-Z]+|[0-9]+"
          r"|[\x00-\x08\x0E-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: A pair's number is its first piece's times this, and its second's.
_TIMES = 1_000_003


def count_repeated(rows: DataFrame, words: str, name: str) -> DataFrame:
    """Add ``name``: the words in windows of WINDOW words that the array ``words`` holds twice or
    more. Windows are told apart by a 64-bit hash of their words."""
    n = F.size(words)
    none = F.array().cast("array<bigint>")
    # Hashes of runs of 1, 2, 4, 8 words: each from two neighbouring halves. Most texts repeat
    # nothing, which a hash set shows: a window that comes twice has its half twice, so texts
    # without such a half go no further, and of the others only those with a window are sorted.
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.withColumn("_h", F.when(n > WINDOW, F.transform(
        words, lambda w: F.xxhash64(w))).otherwise(none))
    half = 1
    while half < WINDOW:
        left = F.greatest(F.size("_h") - half, F.lit(0))
        longer = F.zip_with(
            F.slice("_h", 1, left), F.slice("_h", half + 1, left), lambda a, b: F.xxhash64(a, b))
        half *= 2
        rows = rows.withColumn("_h", F.when(again, longer).otherwise(none)
                               if half == WINDOW else longer)
    sort = F.sort_array(F.transform("_h", lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    rows = rows.withColumn("_s", F.when(again, sort).otherwise(
        F.array().cast("array<struct<h:bigint,k:int>>"))).drop("_h")
    pairs = F.size("_s") - 1
    same = F.zip_with(F.slice("_s", 1, pairs), F.slice("_s", 2, pairs),
                      lambda a, b: F.when(a.h == b.h, F.array(a.k, b.k)).otherwise(
                          F.array().cast("array<int>")))
    rows = rows.withColumn("_p", F.when(pairs > 0, F.sort_array(F.array_distinct(
        F.flatten(same)))).otherwise(F.array().cast("array<int>"))).drop("_s")
    more = F.size("_p") - 1
    gaps = F.zip_with(F.slice("_p", 1, more), F.slice("_p", 2, more),
                      lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("bigint"), lambda t, g: t + g)
    return rows.withColumn(name, F.when(more >= 0, covered).otherwise(
        F.lit(0).cast("bigint"))).drop("_p")


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every row, with
    ``_row``, its number in the scan, and ``text`` (null: empty)."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_w", F.array_remove(F.split("text", _BLANK + "+"), "")).withColumn(
        "_l", F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD)))
    rows = rows.select(
        "_row", "doc_id", "text", "_w", F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOL)).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"))
    return count_repeated(rows, "_w", "n_repeat_words").drop("_w")


def with_buckets(rows: DataFrame, buckets: int, name: str, outer: bool = False) -> DataFrame:
    """``rows`` without ``text``, once for the bucket of each of its n-grams: its pieces, and pairs
    of neighbours. With ``outer``, a text without any stays once, with a null."""
    mask = F.lit(buckets - 1).cast("bigint")
    rows = rows.withColumn("_g", F.transform(
        F.regexp_extract_all("text", F.lit(_PIECE), F.lit(0)), lambda x: F.crc32(x))).drop("text")
    pairs = F.greatest(F.size("_g") - 1, F.lit(0))
    both = F.zip_with(F.slice("_g", 1, pairs), F.slice("_g", 2, pairs),
                      lambda a, b: a * _TIMES + b)
    # The array is a column before it is exploded, so that the n-grams need no row of their own
    # on the way to what is counted; lambdas beside the explode would keep it out of the generated
    # code. A filter that Spark infers for an inner explode would cut the texts twice.
    names = [c for c in rows.columns if c != "_g"]
    rows = rows.select(*names, F.concat("_g", both).alias("_b"))
    rows = rows.select(*names, F.explode_outer("_b").alias(name))
    rows = rows if outer else rows.filter(F.col(name).isNotNull())
    return rows.withColumn(name, F.col(name).bitwiseAND(mask))


def buckets_for(size: int) -> int:
    """Buckets for a corpus of ``size`` bytes of text."""
    wish = math.ceil(math.log2(max(size, 1) / BYTES_PER_BUCKET)) if size else 0
    return 1 << min(LARGEST, max(SMALLEST, wish))


def _trusted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good``: whether the row's doc_id is labelled with quality 1."""
    ids = labels.filter("quality = 1 and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("_good")).distinct()
    ids = written(ids, "trusted_ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.join(ids, F.col("doc_id") == F.col("_good"), "left").withColumn(
        "good", F.col("_good").isNotNull().cast("int")).drop("_good")


def bucket_weights(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """bucket, weight: 1/SCALE nats by which the target favours a bucket over the raw corpus.

    Without any trusted document the weights are 0: nothing is known against any text.
    """
    rows = _trusted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    grams = with_buckets(rows.select("good", "text"), buckets, "bucket")
    counts = written(grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("good").alias("target")), "bucket_counts")
    total = counts.agg(F.sum("raw"), F.sum("target")).first()
    raw, target = (x or 0 for x in total)
    ratio = F.ln((F.col("target") + 1) / F.lit(float(target + buckets))
                 / ((F.col("raw") + 1) / F.lit(float(raw + buckets))))
    return counts.select("bucket", F.round(ratio * SCALE).cast("bigint").alias("weight")
                         if target else F.lit(0).cast("bigint").alias("weight"))


def judge_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Contract of op11, one row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score.

    Null and empty texts have no words, fail the base rules and have no score. Repeated rows are
    judged alike; a null doc_id is never trusted. Labels without a document, or with a null, play
    no part; an empty table of labels leaves the base rules alone to decide; an empty table of
    documents gives an empty result.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets_for(size)
    weights = bucket_weights(docs, labels, buckets)
    rows = base_rules(docs)
    names = [c for c in rows.columns if c != "text"]
    # Every n-gram's bucket has been counted, so the join drops only rows without any.
    grams = with_buckets(rows, buckets, "bucket", outer=True)
    # Grouped by the row's number alone: n-grams are many, and a key of all columns costs each one.
    judged = grams.join(F.broadcast(weights), "bucket", "left").groupBy("_row").agg(
        *(F.max(c).alias(c) for c in names[1:]),
        F.sum("weight").alias("_sum"), F.count("weight").alias("_n"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough = F.col("_sum") >= F.lit(int(cut * SCALE)).cast("bigint") * F.col("_n")
    return judged.select(
        *names[1:], failed.alias("base_failed"),
        (~failed & F.coalesce(enough, F.lit(True))).alias("kept"),
        (F.col("_sum").cast("double") / F.col("_n") / SCALE).alias("score"))


ORACLE = rf"""
with {CRC_CTE},
d as (select row_number() over () as r, doc_id, coalesce(text, '') as text,
  regexp_extract_all(coalesce(text, ''), '{_WORD}+') as w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l,
  regexp_extract_all(coalesce(text, ''), '{_PIECE}') as p from documents),
b as (select 1::bigint << least({LARGEST}, greatest({SMALLEST}, ceil(log2(
  greatest(sum(strlen(text)), 1) / {BYTES_PER_BUCKET})))::int) as n from d),
good as (select distinct doc_id from labels where quality = 1),
h as (select g, {crc32_sql('g')} as h from (select distinct unnest(p) as g from d), crc),
o as (select r, doc_id, i, h from (select r, doc_id, unnest(p) as g,
  unnest(range(1, len(p) + 1)) as i from d) join h using (g)),
g as (select r, doc_id, x & (b.n - 1) as bucket from (select r, doc_id, h as x from o union all
  select a.r, a.doc_id, a.h * {_TIMES} + e.h from o a join o e on a.r = e.r and a.i + 1 = e.i), b),
c as (select bucket, count(*) as raw, count(good.doc_id) as target
  from g left join good using (doc_id) group by bucket),
t as (select sum(raw) as raw, sum(target) as target from c),
k as (select bucket, case when t.target > 0 then round(ln((c.target + 1) / (t.target + b.n)::double
  / ((c.raw + 1) / (t.raw + b.n)::double)) * {SCALE})::bigint else 0 end as weight from c, t, b),
s as (select r, sum(weight) as s, count(*) as n from g join k using (bucket)
  group by r),
win as (select r, i, count(*) over (partition by r, x) as n from (
  select r, i, w[i:i + {WINDOW - 1}] as x from (
  select r, w, unnest(range(1, len(w) - {WINDOW} + 2)) as i from d where len(w) > {WINDOW}))),
rep as (select r, count(distinct p) as n from (
  select r, unnest(range(i, i + {WINDOW})) as p from win where n > 1) group by r),
e as (select d.r, doc_id, len(w)::bigint as n_words, coalesce(rep.n, 0)::bigint as n_repeat_words,
  length(array_to_string(w, ''))::bigint as word_chars,
  len(regexp_extract_all(text, '{_SYMBOL}'))::bigint as n_symbols,
  (len(l) - len(list_distinct(l)))::bigint as n_dup_lines from d left join rep using (r)),
f as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words
  as base_failed from e)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(s >= {int(CUT * SCALE)} * n, true) as kept,
  s::double / n / {SCALE} as score
from f left join s using (r)
"""

"""Benchmark decontamination by winnowing.

A fingerprint is the minimum hash of K neighbouring K-word runs' window: of every W consecutive
runs the least one is kept, on both sides, so two texts that share a span of K + W - 1 words
share a fingerprint in it. Fingerprints are joined, and each hit is extended word by word to the
windows around it. Items shorter than a window have one fingerprint, their whole sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import LOWER, UPPER, letter_words
from tidelog.sources.shared import written

#: Words of a window that makes a document contaminated.
WINDOW = 10
#: Words of a fingerprint; WINDOW - GRAM + 1 neighbouring ones compete.
GRAM = 5


def _runs(hashes: Column, gram: int) -> Column:
    """Hash of every run of ``gram`` words; the length is hashed too."""
    first = F.sequence(F.lit(0), F.size(hashes) - gram)
    return F.when(F.size(hashes) >= gram, F.transform(first, lambda i: F.xxhash64(
        F.lit(gram), *(F.get(hashes, i + k) for k in range(gram))))).otherwise(
        F.array().cast("array<bigint>"))


def _winnow(runs: Column, gram: int, window: int) -> Column:
    """The least run hash of every ``window - gram + 1`` neighbours, distinct."""
    wide = window - gram + 1
    if wide == 1:
        return F.array_distinct(runs)
    last = F.size(runs) - wide
    return F.when(last >= 0, F.array_distinct(F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.least(*(F.get(runs, i + k) for k in range(wide)))))).otherwise(
        F.array().cast("array<bigint>"))


def _places(df: DataFrame, gram: int, window: int, chosen: Column, keep: list[str]) -> DataFrame:
    """keep..., h, at, back, near: every place whose run hash is in ``chosen``, with the words
    that windows over the run can hold, ``back`` of them before it."""
    runs = df.select(*keep, "words", chosen.alias("_set"), _runs(F.col("hashes"), gram).alias("_r"))
    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size("_r") - 1, F.lit(0))),
                  lambda i: F.array_contains("_set", F.get("_r", i)))
    near = F.transform(at, lambda i: F.struct(
        F.get("_r", i).alias("h"), i.alias("at"),
        F.least(i, F.lit(window - gram)).alias("back"),
        F.slice("words", F.greatest(i - (window - gram), F.lit(0)) + 1,
                F.least(i, F.lit(window - gram)) + window).alias("near")))
    return runs.select(*keep, F.explode(near).alias("_x")).select(*keep, "_x.*")


def _worded(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep..., words, hashes of the words."""
    named = df.select(*keep, letter_words(F.col("text")).alias("words"))
    return named.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))


def _shifts(size: int) -> Column:
    """How far before a hit windows of ``size`` equal words begin."""
    def equal(j: Column) -> Column:
        mine = F.slice("near", F.col("back") - j + 1, size)
        return (F.size(mine) == size) & (mine == F.slice("inear", F.col("iback") - j + 1, size))
    return F.filter(F.sequence(F.lit(0), F.least("back", "iback")), equal)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """doc_id, tag, n_words of every row, and doc_id, tag, hit, items of those with hits.

    tag is the text's hash; hit counts words, items are the ids of items as strings.
    """
    tag = F.xxhash64("text").alias("tag")
    items = _worded(benchmark, ["item_id"]).filter(F.size("words") > 0)
    items = written(items, "bench_words")
    # At most WINDOW - 1 numbers.
    short = [r[0] for r in items.filter(F.size("words") < window).select(
        F.size("words")).distinct().collect()]
    kinds = [(gram, window), *((n, n) for n in sorted(short))]

    known = None
    for g, t in kinds:
        of = items.filter(F.size("words") >= t) if t == window else items.filter(
            F.size("words") == t)
        one = _places(of, g, t, _winnow(_runs(F.col("hashes"), g), g, t), ["item_id"]).select(
            "item_id", F.lit(t).alias("t"), "h", "back", "near")
        known = one if known is None else known.unionByName(one)
    known = written(known, "bench_fingerprints")
    marks = known.select("h").distinct()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    worded = _worded(docs, ["doc_id", tag])
    prints = F.flatten(F.array(*(_winnow(F.col(f"r{g}"), g, t) for g, t in kinds)))
    runs = worded.select("doc_id", "tag", F.size("words").cast("long").alias("n_words"),
                         *(_runs(F.col("hashes"), g).alias(f"r{g}") for g in
                           sorted({g for g, _ in kinds})))
    prints = written(runs.select("doc_id", "tag", "n_words", prints.alias("prints")),
                     "doc_fingerprints")
    met = prints.select("doc_id", "tag", F.explode("prints").alias("h")).join(marks, "h")
    met = written(met.groupBy("doc_id", "tag").agg(F.collect_set("h").alias("_met")), "doc_met")

    # Only documents with a hit are read again.
    again = docs.select("doc_id", "text", tag).join(
        met.withColumnRenamed("doc_id", "_id").withColumnRenamed("tag", "_tag"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag"))).dropDuplicates(
        ["doc_id", "tag"])
    again = written(_worded(again, ["doc_id", "tag", "_met"]), "doc_words")
    hits = None
    for g, t in kinds:
        here = _places(again, g, t, F.col("_met"), ["doc_id", "tag"])
        there = known.filter(F.col("t") == t).select(
            "item_id", "h", F.col("back").alias("iback"), F.col("near").alias("inear"))
        one = here.join(there, "h").select(
            "doc_id", "tag", "item_id", "at", F.explode(_shifts(t)).alias("j")).select(
            "doc_id", "tag", "item_id",
            F.struct((F.col("at") - F.col("j")).alias("s"), F.lit(t).alias("t")).alias("span"))
        hits = one if hits is None else hits.unionByName(one)
    found = hits.groupBy("doc_id", "tag").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["s"] + x["t"]).alias("end"),
        (a["sum"] + F.greatest(F.lit(0), x["s"] + x["t"] - F.greatest(a["end"], x["s"])))
        .cast("long").alias("sum")))
    return prints.select("doc_id", "tag", "n_words"), found.select(
        "doc_id", "tag", covered["sum"].alias("hit"), "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract of op7, one row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.

    A null or empty text has no words and no windows. Items without an id mark words as hit but
    are not named or counted; repeated rows get the same result each; an empty table on either
    side gives no hits.
    """
    rows, found = benchmark_hits(docs, benchmark)
    found = found.withColumnsRenamed({"doc_id": "_id", "tag": "_tag"})
    none = F.array().cast("array<string>")
    return rows.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")),
        "left").select(
        "doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256)
        .alias("items_sha256"), F.coalesce(F.col("hit") > 0, F.lit(False)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    _, found = benchmark_hits(docs, benchmark)
    found = written(found.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")),
                    "contaminated")
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & (
        F.xxhash64(docs["text"]) == found["_tag"]), "left_anti")


def _words_sql(source: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({source}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


ORACLE = f"""
with d as (select row_number() over () as r, doc_id, {_words_sql('text')} as w from documents),
b as (select item_id, {_words_sql('text')} as w from benchmark),
bw as (select distinct item_id, t, w[i:i + t - 1] as g from (
    select item_id, w, least({WINDOW}, len(w)) as t, unnest(range(1, len(w) - t + 2)) as i
    from b where len(w) > 0)),
dw as (select r, t, i, w[i:i + t - 1] as g from (
    select r, w, t, unnest(range(1, len(w) - t + 2)) as i
    from d, (select distinct t from bw) where len(w) >= t)),
hit as (select r, i, t, item_id from dw join bw using (t, g)),
covered as (select r, count(distinct p) as n from (
    select r, unnest(range(i, i + t)) as p from hit) group by r),
named as (select r, count(distinct item_id) as n,
    string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
    from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(covered.n, 0) as n_hit,
  coalesce(named.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(covered.n, 0) > 0 as contaminated
from d left join covered using (r) left join named using (r)
"""

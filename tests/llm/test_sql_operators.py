"""Operators that SQL can express, against their SQL, on edge cases and real text."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import (
    decontamination, exact_dedup, jaccard_join, license_scan, merkle, periodic_runs, quality,
    substring_dedup, url_filter)

SMALL = "/root/testdata/sf0.001"
DOCS = [
    (substring_dedup.remove_repeats, substring_dedup.ORACLE),
    (exact_dedup.exact_dedup, exact_dedup.ORACLE),
    (license_scan.scan_licenses, license_scan.ORACLE),
    (jaccard_join.join_near, jaccard_join.ORACLE),
]


@pytest.mark.parametrize("run,oracle", DOCS)
def test_edge_cases(edge, same, run, oracle):
    same(run(edge), oracle, documents=edge.select("doc_id", "text"))


@pytest.mark.parametrize("run,oracle", DOCS)
def test_real_text(docs, same, run, oracle):
    same(run(docs), oracle, documents=docs.select("doc_id", "text"))


@pytest.mark.parametrize("run,oracle", DOCS)
def test_empty(empty, run, oracle):
    assert run(empty).collect() == []


def test_large_groups_and_blocks(docs, same):
    """Every group above two members goes through pivots, components and blocks of three."""
    same(jaccard_join.join_near(docs, small=2, block=3), jaccard_join.ORACLE,
         documents=docs.select("doc_id", "text"))


def test_nothing_shared(spark, same):
    """One document, unrelated documents, and more partitions than shingles."""
    words = [" ".join(f"{x}{k}" for k in range(12)) for x in "abc"]
    for rows, parts in ([(1, words[0])], 1), (list(enumerate(words)), 3), (
            [(k, words[k % 2] + f" {k}") for k in range(30)], 200):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        same(jaccard_join.join_near(df), jaccard_join.ORACLE, documents=df)


@pytest.mark.parametrize("percent", [30, 50, 75, 90, 100])
def test_similarities(spark, same, percent):
    """Texts that share a given part of their words, at thresholds other than the usual one."""
    rng = random.Random(percent)
    rows = []
    for k in range(60):
        base = [f"w{k}x{j}" for j in range(rng.randrange(8, 60))]
        rows.append(base)
        for _ in range(3):
            rows.append(base[:rng.randrange(1, len(base) + 1)] + [
                f"v{rng.random()}" for _ in range(rng.randrange(6))])
    df = spark.createDataFrame([(k, " ".join(r)) for k, r in enumerate(rows)],
                               "doc_id bigint, text string").repartition(3)
    same(jaccard_join.join_near(df, percent=percent), jaccard_join.oracle(percent=percent),
         documents=df)


def test_hot_minimisers(spark, same):
    """A passage in most documents: its windows travel alone, each by its own hash."""
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, f"a{k} b{k} {passage} c{k} d{k} " + " ".join(f"{k}x{j}" for j in range(30)))
            for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    same(substring_dedup.remove_repeats(df), substring_dedup.ORACLE, documents=df)


def test_benchmark(spark, edge, docs, empty, same):
    items = [(1, "the old mill by the river turns a slow wheel of oak and iron"),
             (2, "turns a slow"), (3, None), (4, ""), (None, "wheel of oak"), (5, "x"),
             (6, "turns a slow"), (7, "w0 w1 w4 w9 w16 w25 w36 w49 w64 w81 w100 w121")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    same(decontamination.decontaminate(edge, bench), decontamination.ORACLE,
         documents=edge.select("doc_id", "text"), benchmark=bench)
    none = decontamination.decontaminate(edge, bench.filter("false")).collect()
    assert len(none) == edge.count() and not any(r.contaminated for r in none)
    assert decontamination.decontaminate(empty, bench).collect() == []
    left = decontamination.drop_contaminated(edge, bench)
    assert left.columns == edge.columns
    assert left.count() == sum(not r.contaminated for r in decontamination.decontaminate(
        edge, bench).collect())


def test_urls(spark, same):
    urls = [None, "", "no scheme", "http://", "https://A.Example.NET/en/1?x#y", "ftp://net", "x://net/",
            "http://a.net/de/7", "http://a.net/en/", "http://example.net/en/b", "http://xnet/",
            "http://b.org/fr/2", "http://b.example.com/de/3", "http://b.example.com/en/3",
            "a://b://c/d", "http://q.net?z", "http://q.net/a/b/c/d/e/f/g/1"]
    urls += [f"http://site.example.com/{'de' if k % 3 else 'fr'}/s{k}/{k}" for k in range(300)]
    urls += ["http://a.net/de/7"] * 50
    urls += [f"http://deep.example.com/a/b/c/d/e/{'spam' if k % 2 else 'news'}/f/{k}" for k in range(9)]
    urls += [f"http://wide.example.org/x/{chr(97 + k % 26)}{chr(97 + k % 7)}/{k}/" for k in range(400)]
    urls += ["http://long.org/" + "/".join(f"s{chr(97 + k % 26)}" for k in range(2_000))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    same(url_filter.filter_urls(pages), url_filter.ORACLE, pages=pages)
    assert url_filter.filter_urls(pages.filter("false")).collect() == []


def test_unruled_urls_are_decided_by_their_template(spark, same):
    """Six segments down, and on a host of its own: bad sections that no rule names."""
    rules = [("bad.com/", "block"), ("good.com/", "allow"), ("mixed.com/a/b/c/d/e/spam/x/", "block"),
             ("mixed.com/a/b/c/d/e/news/x/", "allow")]
    urls = [f"http://h{k % 40}.bad.com/offers/win/{k}" for k in range(400)]
    urls += [f"http://h{k % 40}.good.com/articles/{k}" for k in range(400)]
    urls += [f"http://mixed.com/a/b/c/d/e/{kind}/x/{k}" for kind in ("spam", "news") for k in range(300)]
    ruled = len(urls)
    urls += [f"http://mixed.com/a/b/c/d/e/{kind}/y/{k}" for kind in ("spam", "news") for k in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = url_filter.filter_urls(pages, rules).filter(F.col("page_id") >= ruled).collect()
    assert len(rows) == 60 and all(r.rule is None for r in rows)
    assert {("spam" in r.path, r.verdict) for r in rows} <= {(True, "block"), (False, "allow"), (True, "allow")}
    assert all(r.purity > 0.7 if "spam" in r.path else r.purity < 0.3 for r in rows)


def test_very_long_text(spark):
    """A text of 120,000 words is taken whole."""
    words = [f"w{k}" for k in range(60_000)]
    text = " ".join(words + words)
    df = spark.createDataFrame([(1, " ".join(words)), (2, text), (3, text)],
                               "doc_id bigint, text string")
    cut = {r.doc_id: r for r in substring_dedup.remove_repeats(df).collect()}
    assert (cut[1].n_removed, cut[2].n_words, cut[3].n_removed) == (0, 120_000, 120_000)
    # The windows that join the halves are new, but others cover their words.
    assert cut[2].n_removed == 120_000
    near = {r.doc_id: r for r in jaccard_join.join_near(df).collect()}
    assert near[3].component_id == near[2].component_id == near[1].component_id == 1
    assert near[1].n_shingles == 59_996 and near[2].n_shingles == 60_000
    bench = spark.createDataFrame([(9, " ".join(words[59_990:] + words[:5]))],
                                  "item_id bigint, text string")
    hits = {r.doc_id: r.n_hit for r in decontamination.decontaminate(df, bench).collect()}
    assert hits == {1: 10, 2: 25, 3: 25}
    assert all(r.n_words >= 60_000 for r in license_scan.scan_licenses(df).collect())


def test_quality(spark, edge, docs, empty, same):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 1, 0), (7, 1, None), (None, 1, 0), (9, None, 1), (999, 1, 0),
         (12, 0, 0), (12, 0, 0)], "doc_id bigint, quality int, toxic int")
    both = {"documents": edge.select("doc_id", "text"), "labels": labels}
    same(quality.judge_quality(edge, labels), quality.ORACLE, **both)
    none = labels.filter("false")
    alone = quality.judge_quality(edge, none)
    same(alone, quality.ORACLE, documents=both["documents"], labels=none)
    assert all(r.kept != r.base_failed for r in alone.collect())
    assert quality.judge_quality(empty, labels).collect() == []
    real = spark.read.parquet(f"{SMALL}/labels.parquet")
    same(quality.judge_quality(docs, real), quality.ORACLE,
         documents=docs.select("doc_id", "text"), labels=real)


def test_repeated_windows_and_lines(spark, same):
    """Overlapping repeats, a repeat that touches the end, equal and blank lines, every symbol."""
    a = " ".join(f"w{k}" for k in range(30))
    texts = ["x " * 9, "x " * 8, a + " " + a, a + "\n" + a + "\n \n" + a + " ", "\n\n\t\n",
             " ".join(f"w{k % 8}" for k in range(16)), a[:60] + " q " + a[:60], "#*$%&|<> a #" * 9,
             "é É 1\x0bé É 1\x0b" * 20, a + " w0 w1 w2 w3 w4 w5 w6", a + " w0 w1 w2 w3 w4 w5 w6 w7"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (2, 1)], "doc_id bigint, quality int")
    same(quality.judge_quality(df, labels), quality.ORACLE, documents=df, labels=labels)


def test_quality_ngrams_stay_in_generated_code(spark):
    """N-grams are exploded from a column, inside generated code, and grouped by one number."""
    rows = [(k, f"word{k} and more words of text {k} " * 6) for k in range(20)]
    docs = spark.createDataFrame([*rows, (20, None), (21, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    judged = quality.judge_quality(docs, labels)
    assert len(judged.collect()) == 22
    plan = judged._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert re.search(r"\*\(\d+\) Generate explode\(_b#\d+\)", final)
    assert re.findall(r"HashAggregate\(keys=\[(\w+)#\d+L?\], functions=\[(?:partial_)?max", final)
    assert "Generate explode(concat" not in plan


def test_repeats_of_half_windows(spark, same):
    """Halves of windows that come twice, without and with a whole window that does."""
    half, other = "one two three four", "five six seven eight"
    words = " ".join(f"w{k}" for k in range(20))
    texts = [f"{half} {words} {half}", f"{half} {other} {words} {half} {other}", f"{half} " * 3,
             f"{half} {half}", f"{half} {half} one", f"{words} {half} x {half} {other} {half}",
             f"{half} {other} {other} {half} {other}", "a " * 9, "a " * 8, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (5, 1)], "doc_id bigint, quality int")
    judged = quality.judge_quality(df, labels)
    same(judged, quality.ORACLE, documents=df, labels=labels)
    found = {r.doc_id: r.n_repeat_words for r in judged.collect()}
    assert [found[k] for k in range(11)] == [0, 16, 12, 0, 0, 0, 16, 9, 0, 0, 0]


def test_quality_on_held_out_labels(spark):
    """Trusted rows of three quarters; junk and clean documents of the rest."""
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    judged = quality.judge_quality(docs, labels.filter("doc_id % 4 != 2")).filter("not base_failed")
    rows = judged.join(labels.filter("doc_id % 4 = 2"), "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert len(good) > 50 and all(good)
    assert len(bad) >= 5 and sum(bad) <= 0.1 * len(bad)


def brute_runs(words):
    """Every run by its definition: each stretch that a lag cannot extend, smallest period first."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_periodic_runs(edge, docs, empty, same):
    run = periodic_runs.collapse_runs
    same(run(edge, planted=True), periodic_runs.ORACLE, documents=edge.select("doc_id", "text"))
    same(run(docs, planted=True), periodic_runs.ORACLE, documents=docs.select("doc_id", "text"))
    assert run(empty).collect() == []


def test_periodic_runs_by_definition(spark):
    rng = random.Random(7)
    texts = ["", "x", "x " * 5, "x " * 6, "a b " * 3, "a b " * 4, "a b c " * 4, "a b c " * 4 + "a",
             "z " + "a a b " * 9 + "a a c", "x y " * 40 + "x x " * 40, "a " * 500, ("p " * 7 + "q ") * 9]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(400))) for _ in range(60)]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(90)) + " "
              + " ".join("uvwxyz"[:rng.randrange(1, 6)] * rng.randrange(1, 9)) for _ in range(60)]
    texts += [" ".join((" ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 30))) + " ")
                       * rng.randrange(1, 9) for _ in range(6)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for r in periodic_runs.collapse_runs(df).collect():
        words = texts[r.doc_id].split()
        runs = brute_runs(words)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r.n_runs, r.runs_sha256) == (len(runs), sha256(listed.encode()).hexdigest())
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert r.collapsed_sha256 == sha256(left.encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, q, 1000 * n // q)


def test_one_word_many_times(spark):
    """A text of 300,000 equal words, and one of two words in no order, take no quadratic time."""
    rng = random.Random(3)
    mixed = " ".join(rng.choice("ab") for _ in range(60_000))
    df = spark.createDataFrame([(1, "a " * 300_000), (2, mixed)], "doc_id bigint, text string")
    one, two = sorted(periodic_runs.collapse_runs(df).collect())
    assert (one.n_runs, one.length, one.period) == (1, 300_000, 1)
    assert two.n_runs > 1000


def with_fields(df):
    """The five columns of documents, from doc_id and text."""
    return df.select(
        "doc_id", F.when(F.col("doc_id") % 3 != 1, F.concat(F.lit("s"), F.col("doc_id") % 3)).alias(
            "source"), F.when(F.col("doc_id") % 5 > 0, F.lit("é")).alias("lang"),
        F.length("text").cast("bigint").alias("n_chars"), "text", F.lit("x").alias("leaf"),
        F.lit(1).alias("size"))


def test_manifest(edge, docs, empty, same):
    for d in (with_fields(edge), with_fields(docs)):
        same(merkle.prove_rows(d), merkle.ORACLE, documents=d.drop("leaf", "size"))
    assert merkle.prove_rows(with_fields(empty)).collect() == []
    one = with_fields(edge.filter("doc_id = 7"))
    r = merkle.prove_rows(one).first()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha256(b"").hexdigest()


def test_manifest_of_many_rows(spark, same):
    """Several rounds of blocks, dense and sparse containers, negative and distant ids, copies."""
    rows = spark.range(9_000).selectExpr("id as doc_id", "concat('line ', id, '\\n') as text").unionByName(
        spark.range(300).selectExpr("(id - 150) * 40000000000000000 as doc_id", "'far' as text"))
    rows = rows.unionByName(spark.range(4_200).selectExpr("cast(30 as bigint) as doc_id", "'copy' as text"))
    rows = rows.unionByName(spark.range(900).selectExpr(
        "cast(id % 7 as bigint) as doc_id", "cast(id % 90 as string) as text"))
    rows = with_fields(rows.repartition(5)).withColumn("source", F.when(
        F.abs(F.hash("doc_id")) % 4 > 0, F.lit("hot")).otherwise(F.col("source")))
    same(merkle.prove_rows(rows), merkle.ORACLE, documents=rows.drop("leaf", "size"))


def test_rank_queries():
    rng = random.Random(11)
    for size in (1, 4095, 4096, 30_000, 65_536):
        ids = sorted(rng.sample(range(1 << 16), size))
        many = ids[::7]
        blob = merkle._container(np.array(ids))
        at = merkle.Ranks(blob, np.array(many, np.uint16).tobytes(), np.full(len(many), 3).tobytes())
        before = {x: k + 2 * -(-k // 7) for k, x in enumerate(ids)}
        assert at.rank(np.array(ids)).tolist() == list(before.values())


def test_counters_grow_with_the_buckets():
    """What counts as hot stays the same part of a bucket, so the share of lone windows does not
    rise with the input: an average counter is at most a quarter of the threshold."""
    for buckets in (1, 500, 4_000, 60_000, 260_000):
        counters = substring_dedup.counters_for(buckets)
        total = 15_000 * buckets
        assert counters & (counters - 1) == 0 and total / counters <= total / (4 * buckets) / 4


def test_rows_repeated_very_often(spark, same):
    """A third of all rows alike: they travel once a task, and come back as often as they are."""
    text = " ".join(f"t{k}" for k in range(30))
    rows = [(k, f"x{k} {text if k % 5 == 0 else ''} y{k}") for k in range(300)] + [(3, text)] * 200
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    same(substring_dedup.remove_repeats(df), substring_dedup.ORACLE, documents=df)


def test_licenses_and_their_relatives(spark, same):
    """Every header inside other words gets its own label alone; relatives without a template none."""
    about = "some notes on the engine and its parts by the authors"
    rows, want = [], {}

    def add(text, labels):
        want[len(rows)] = labels
        rows.append((len(rows), f"{about}\n# {text}\n{about} with the usual words of the trade"))

    for label, text, _, _ in license_scan.HEADERS:
        add(text, label)
        add(text.upper().replace(", ", ",\n * "), label)
    add(license_scan.CREATIVE.format("Attribution") + " and " + license_scan.HEADERS[0][1], "cc-by,mit")
    # Known relatives: other versions and families.
    add("The Apache Software License, Version 1.1", "")
    add("Licensed under the Apache License, Version 1.1", "")
    add(license_scan.GNU.format("", "1"), "")
    add(license_scan.GNU.format("Library ", "2"), "")
    add(license_scan.CREATIVE.format("Zero"), "")
    add("Creative Commons Attribution-NonCommercial 4.0", "cc-by-nc")
    add(license_scan.BSD + " All advertising materials mentioning features or use of this software "
        "must display the following acknowledgement." + license_scan.BSD_NAME, "")
    add("permission is hereby granted to the public, and the software is free of charge", "")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.scan_licenses(docs)
    assert {r.doc_id: r.labels for r in got.collect()} == want
    same(got, license_scan.ORACLE, documents=docs)

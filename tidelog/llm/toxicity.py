"""Toxicity by weak supervision.

Many voters, fixed lexicons of several languages, patterns, and lexicons mined from the labelled
sample, fire or stay silent on every document. A generative label model is fitted by expectation maximisation to how
often each combination of votes occurs among all documents, with the labelled sample's labels
clamped; it gives the class share, each voter's accuracy and the correlations left within a
class, by which correlated voters are discounted. Its posteriors label a sample, on which a
linear classifier of word and word-beginning counts is trained; that one scores every document.

Labels come only from rows whose crc32(doc_id) modulo 4 is not 2. Samples are bounded by SAMPLE.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm import insults
from tidelog.llm.hashing import mix, span_hashes, word_spans

#: Rows of the labelled sample and of the sample the classifier is trained on.
SAMPLE = 3000
#: Voters mined from the labelled sample, and the features of the classifier.
MINED, FEATURES = 8, 400
#: Score from which a document is predicted toxic.
CUT = 0.3
#: Bytes of the word beginnings that count as features beside the words.
HEADS = (4, 5, 6, 8)

#: Voters that are not mined: the lexicons, then the patterns.
FIXED = len(insults.LISTS) + len(insults.PATTERNS)

_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of every word and word beginning in the texts."""
    owners, hashes = [], []
    for k, text in enumerate(texts):
        buffer = b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split())
        starts, ends = word_spans(buffer)
        found = [span_hashes(buffer, starts, ends)]
        for n, size in enumerate(HEADS):
            long = ends - starts > size
            found.append(mix(span_hashes(buffer, starts[long], starts[long] + size)
                             + np.uint64(n + 1)))
        for part in found:
            owners.append(np.full(len(part), k, np.int64))
            hashes.append(part)
    none = np.empty(0, np.uint64)
    return (np.concatenate(owners) if owners else none.astype(np.int64),
            np.concatenate(hashes) if hashes else none)


@dataclass
class Lookup:
    """A sorted list of feature hashes with a small filter before the search."""

    hashes: np.ndarray
    bits: int = 16

    def __post_init__(self) -> None:
        order = np.argsort(self.hashes)
        self.hashes, self.order = self.hashes[order], order
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)] = True

    def find(self, own: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owner and number of the listed feature, for every occurrence of one."""
        some = self.maybe[(h & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
        own, h = own[some], h[some]
        if not len(self.hashes):
            return own[:0], own[:0]
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        same = self.hashes[at] == h
        return own[same], self.order[at[same]]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Texts by features: how often each occurs."""
        out = np.zeros((len(texts), len(self.hashes)), np.float32)
        for first in range(0, len(texts), 256):
            own, at = self.find(*features(texts[first:first + 256]))
            np.add.at(out, (own + first, at), 1)
        return out


def _hash_words(words: list[str]) -> np.ndarray:
    buffer = " ".join(words).encode()
    return span_hashes(buffer, *word_spans(buffer))


def _strength(texts: list[str], weight: np.ndarray):
    """Features of three texts or more, the texts that have them, the toxic ones among these, and
    the z value of that share against the sample's."""
    count = len(texts)
    each = [np.unique(features([t])[1]) for t in texts]
    share = min(max(weight.sum() / max(count, 1), 1e-3), 1 - 1e-3)
    out = []
    for part in range(16):  # a sixteenth of the features at a time is sorted
        some = [x[(x & np.uint64(15)) == part] for x in each]
        own = np.repeat(np.arange(count), [len(x) for x in some])
        names, at = np.unique(np.concatenate(some), return_inverse=True)
        docs = np.bincount(at, minlength=len(names)).astype(float)
        bad = np.bincount(at, weights=weight[own], minlength=len(names))
        often = docs >= 3
        out.append((names[often], docs[often], bad[often]))
    names, docs, bad = (np.concatenate(x) for x in zip(*out))
    z = (bad - share * docs) / np.sqrt(share * (1 - share) * docs)
    return names, docs, bad, z


@dataclass
class Voters:
    """Listed features, and which voter has which of them (features by voters). Voters are the
    lexicons, the patterns, which have none, and the mined ones."""

    lookup: Lookup
    member: np.ndarray

    @property
    def size(self) -> int:
        return self.member.shape[1]

    def masks(self, texts: list[str]) -> np.ndarray:
        """One bit per voter: a lexicon fires on one of its words, a mined voter on two occurrences
        of its features."""
        times = np.zeros((len(texts), self.size), np.int64)
        for first in range(0, len(texts), 256):
            part = texts[first:first + 256]
            own, at = self.lookup.find(*features(part))
            for v in range(self.size):
                times[first:first + len(part), v] = np.bincount(
                    own[self.member[at, v]], minlength=len(part))
        votes = times >= np.where(np.arange(self.size) < FIXED, 1, 2)
        lists = len(insults.LISTS)
        if texts:
            votes[:, lists:FIXED] = insults.fired(texts, _LETTERS, votes[:, :lists].any(axis=1))
        return votes @ (1 << np.arange(self.size))


def mine(texts: list[str], labels: np.ndarray) -> Voters:
    """Voters: fixed ones, and MINED lexicons of features that are far likelier in toxic rows.

    Features that fire on the same rows are dealt to one voter as far as possible.
    """
    forms = sorted(insults.FORMS)
    names = [_hash_words(forms)]
    listed = np.zeros((len(forms), FIXED + MINED), bool)
    for v, some in enumerate(insults.LISTS):
        listed[:, v] = [not insults.FORMS[w].isdisjoint(some) for w in forms]
    voter: list[int] = []
    if len(texts) and labels.sum() >= 5:
        found, docs, bad, z = _strength(texts, labels.astype(float))
        good = np.flatnonzero((bad >= 4) & (bad / docs >= 0.8) & ~np.isin(found, names[0]))
        good = good[np.lexsort((found[good], -z[good]))][:40 * MINED]
        if len(good):
            hits = Lookup(found[good]).counts(texts) > 0
            groups: list[np.ndarray] = []
            for k in range(len(good)):
                rows = hits[:, k]
                near = [(rows & g).sum() / max(1, min(rows.sum(), g.sum())) for g in groups]
                best = int(np.argmax(near)) if near else -1
                if len(groups) < MINED and (best < 0 or near[best] < 0.5):
                    groups.append(rows.copy())
                    best = len(groups) - 1
                else:
                    groups[best] |= rows
                names.append(found[good[k]:good[k] + 1])
                voter.append(best + FIXED)
    mined = np.arange(FIXED + MINED) == np.array(voter, np.int64)[:, None]
    return Voters(Lookup(np.concatenate(names)), np.concatenate([listed, mined]))


def label_model(masks: np.ndarray, counts: np.ndarray, seen: np.ndarray, size: int,
                rounds: int = 60) -> np.ndarray:
    """Posterior of label 1 for every vote mask.

    counts: documents per mask; seen: masks by label, of the labelled sample. A voter that stays
    silent abstains, which is no evidence; that all are silent is a vote of its own.
    """
    fires = (masks[:, None] >> np.arange(size) & 1).astype(float)
    fires = np.column_stack([fires, fires.sum(axis=1) == 0])
    size += 1
    if seen.sum() >= 20:
        share = (seen[:, 1].sum() + 1) / (seen.sum() + 2)
        rate = np.stack([(seen[:, y] @ fires + s) / (seen[:, y].sum() + 1)
                         for y, s in ((0, 0.02), (1, 0.3))])
    else:
        share, rate = 0.1, np.stack([np.full(size, 0.02), np.full(size, 0.4)])
        rate[:, -1] = 0.95, 0.2

    def logit(weight: np.ndarray) -> np.ndarray:
        p = np.clip(rate, 1e-3, 1 - 1e-3)
        return np.log(share / (1 - share)) + fires @ (np.log(p[1] / p[0]) * weight)

    free = np.maximum(counts - seen.sum(axis=1), 0)
    weight = np.ones(size)
    post = 1 / (1 + np.exp(-logit(weight)))
    for _ in range(rounds):
        total = [free * (1 - post) + seen[:, 0], free * post + seen[:, 1]]
        share = (total[1].sum() + 1) / (total[0].sum() + total[1].sum() + 2)
        rate = np.stack([(t @ fires + s) / (t.sum() + 1)
                         for t, s in zip(total, (0.02, 0.3))])
        # Correlation left within the classes: voters that fire together count less.
        together = np.zeros((size, size))
        for t, p in zip(total, rate):
            apart = fires - p
            cov = (apart * t[:, None]).T @ apart / max(t.sum(), 1)
            sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            together += t.sum() * np.clip(cov / sd[:, None] / sd, 0, 1)
        together /= max(total[0].sum() + total[1].sum(), 1)
        np.fill_diagonal(together, 0)
        weight = 1 / (1 + together.sum(axis=1))
        post = 1 / (1 + np.exp(-logit(weight)))
    return post


@dataclass
class Linear:
    lookup: Lookup
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.log1p(self.lookup.counts(texts))
        return 1 / (1 + np.exp(-(x @ self.weights + self.bias)))


def train(texts: list[str], target: np.ndarray, rounds: int = 300) -> Linear:
    """Logistic regression on soft labels over the FEATURES strongest features."""
    names = np.empty(0, np.uint64)
    if len(texts):
        found, docs, bad, z = _strength(texts, target)
        strong = np.flatnonzero((docs >= 3) & (np.abs(z) >= 4))
        names = found[strong[np.lexsort((found[strong], -np.abs(z[strong])))][:FEATURES]]
    lookup = Lookup(names)
    base = float(np.clip(target.mean() if len(target) else 0.1, 0.01, 0.9))
    weights, bias = np.zeros(len(names)), float(np.log(base / (1 - base)))
    if not len(names):
        return Linear(lookup, weights, bias)
    x = np.log1p(lookup.counts(texts)).astype(float)
    # Columns are in the order of the names given; the step suits the largest curvature.
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for k in range(1, rounds + 1):
        gap = 1 / (1 + np.exp(-(x @ weights + bias))) - target
        grad = np.append(x.T @ gap / len(x) + 1e-4 * weights, gap.mean())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        step = 0.05 * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        weights, bias = weights - step[:-1], bias - step[-1]
    return Linear(lookup, weights, bias)


def _map(run, name: str, kind: pa.DataType):
    """mapInArrow over (doc_id, text, held_out): replaces the text by ``run(texts)``."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            parts = [run(texts[k:k + 512]) for k in range(0, len(texts), 512)]
            values = np.concatenate(parts) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values, kind)],
                names=["doc_id", "held_out", name])
    return over


def _one_each(rows: DataFrame, ids: DataFrame) -> list:
    """The ids' documents by doc_id, one for each id: of repeated ones that of the least hash.

    Copies are reduced before they are shuffled; there are SAMPLE rows at most.
    """
    least = F.min(F.struct(F.xxhash64("text"), "text"))["text"]
    return sorted(rows.join(F.broadcast(ids), "doc_id").groupBy(*ids.columns).agg(
        least.alias("text")).collect(), key=lambda r: r.doc_id)


def fit(docs: DataFrame, labels: DataFrame) -> Linear:
    """Voters, label model and classifier, from all documents and the labelled sample."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       held_out(F.col("doc_id")).alias("held_out"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(
        ~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = spark.createDataFrame(
        known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect(),
        "doc_id bigint, toxic int")
    sample = _one_each(rows, some)
    texts = [r.text or "" for r in sample]
    given = np.array([int(r.toxic > 0) for r in sample], np.int64)
    voters = mine(texts, given)

    masks = rows.mapInArrow(_map(voters.masks, "mask", pa.int64()),
                            "doc_id bigint, held_out boolean, mask bigint")
    # At most one row per combination of votes, 2^17 in all.
    found = {r["mask"]: r["count"] for r in masks.groupBy("mask").count().collect()}
    own = voters.masks(texts) if texts else np.empty(0, np.int64)
    names = np.array(sorted(set(found) | set(own.tolist())), np.int64)
    seen = np.zeros((len(names), 2))
    np.add.at(seen, (np.searchsorted(names, own), given), 1)
    counts = np.array([found.get(int(m), 0) for m in names], float)
    post = label_model(names, counts, seen, voters.size) if len(names) else np.empty(0)

    # The label model's posteriors are the targets, of labelled rows as well.
    unlabelled = rows.filter(~F.col("held_out") & F.col("doc_id").isNotNull()).select(
        "doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(SAMPLE)
    picked = spark.createDataFrame(unlabelled.collect(), "doc_id bigint").join(
        F.broadcast(some.select("doc_id")), "doc_id", "left_anti")
    more = _one_each(rows, picked)
    others = [r.text or "" for r in more]
    theirs = voters.masks(others) if others else np.empty(0, np.int64)
    soft = [post[np.searchsorted(names, own)] if len(own) else np.empty(0),
            post[np.minimum(np.searchsorted(names, theirs), len(names) - 1)]
            if len(theirs) else np.empty(0)]
    return train(texts + others, np.concatenate(soft))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract of op6, one row per document: doc_id, held_out, score, predicted.

    Null and empty texts have no features: their score is the classifier's base rate. A null
    doc_id is not held out. Repeated rows get the same score; with no labelled rows only the fixed
    voters teach; an empty table gives an empty result.
    """
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(_map(model.scores, "score", pa.float64()),
                           "doc_id bigint, held_out boolean, score double").select(
        "doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below CUT, with all their columns."""
    model = fit(docs, labels)
    text = docs.columns.index("text")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            keep = [model.scores(texts[k:k + 512]) < CUT for k in range(0, len(texts), 512)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))

    return docs.mapInArrow(over, docs.schema)

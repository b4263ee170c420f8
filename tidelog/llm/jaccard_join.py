"""N-gram Jaccard join by rare-first prefix filtering.

Two documents link when their sets of GRAM-word shingles have a Jaccard similarity of at least
PERCENT / 100. Every set is ordered by how rare its shingles are (counts of all documents in a
fixed number of counters, then hash: one order for all). Linked sets share their first common
shingle within short prefixes, so only prefixes are joined, under the length filter and, at the
shingle met, the positional filter. Surviving pairs pass a suffix filter, which bounds the
overlap by the sets' counts over hash ranges, and are verified once against whole sets.

Equal sets are one class, whatever the number of copies. A shingle whose prefix group is large
gives pairs of its members with a few pivots, not all pairs; when the components of these links
are known, only members of different components are compared, in blocks, so that every pair not
already connected is decided and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import join_groups, keep_rows, partitions_for
from tidelog.llm.hashing import mix, run_hashes
from tidelog.llm.substring_dedup import Words, _chunks
from tidelog.sources.shared import written

GRAM, PERCENT = 5, 75
#: Counters of shingle counts, and those in one stored piece of them.
COUNTERS, PIECE = 1 << 20, 1 << 12
#: Prefix shingles in a bucket; a shingle of more than SPLIT is dealt to several.
BUCKET, SPLIT = 600_000, 300_000
#: Members of a prefix group compared all with all, pivots of a larger one, members of a block.
SMALL, PIVOTS, BLOCK = 24, 4, 2048
#: Hash ranges of the suffix filter.
RANGES = 256

_SALT = np.uint64(0xA24BAED4963EE407)


def shingle_sets(texts: list[str], gram: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``gram`` are one shingle."""
    words = Words([t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                   for t in texts])
    runs = run_hashes(words.hashes, gram)
    for first, n in zip(words.first.tolist(), words.sizes.tolist()):
        if n >= gram:
            yield np.unique(runs[first:first + n - gram + 1])
        else:
            yield run_hashes(words.hashes[first:first + n], n) if n else runs[:0]


def class_of(shingles: np.ndarray) -> tuple[int, int]:
    """96 bits that name a set."""
    return (int(mix(shingles).sum(dtype=np.uint64)),
            int(mix(shingles ^ _SALT).sum(dtype=np.uint64)) & 0xFFFFFFFF)


def _name(high: int, low: int) -> bytes:
    return high.to_bytes(8, "big") + low.to_bytes(4, "big")


def _profile(shingles: np.ndarray) -> bytes:
    """Counts over hash ranges; empty, which passes all, if one is too large to store."""
    counts = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=RANGES)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def _describe(gram: int):
    """A row per document: doc, tag, n, cls, profile; and per task the counters, in pieces."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("n", pa.int64()),
                            ("cls", pa.binary()), ("profile", pa.binary()),
                            ("piece", pa.int32()), ("counts", pa.binary())])
        total = np.zeros(COUNTERS, np.int64)
        for docs, tags, texts in _chunks(batches):
            rows = []
            for shingles in shingle_sets(texts, gram):
                np.add.at(total, (shingles >> np.uint64(44)).astype(np.int64), 1)
                rows.append((len(shingles), _name(*class_of(shingles)), _profile(shingles)))
            n, cls, profile = zip(*rows)
            none = pa.nulls(len(docs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(tags, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(cls, pa.binary()), pa.array(profile, pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
        pieces = np.minimum(total, 1 << 30).astype(np.int32).reshape(-1, PIECE)
        used = np.flatnonzero(pieces.any(axis=1))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
            + [pa.array(used, pa.int32()),
               pa.array([squeeze(pieces[k].tobytes()) for k in used], pa.binary())],
            schema=schema)
    return over


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(PIECE, np.int64)
    for blob in table.column("counts").to_pylist():
        total += np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int32)
    return pa.table({"piece": table.column("piece").slice(0, 1),
                     "counts": [np.minimum(total, 1 << 30).astype(np.int32).tobytes()]})


_KINDS = [np.uint64, np.uint64, np.uint32, np.int32, np.int32, np.uint8]


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of n of which a linked set must have one."""
    return n - -(-percent * n // 100) + 1


def _prefixes(gram: int, parts: int, counters, percent: int):
    """Prefix shingles with class, set size, place, and whether the shingle is split; packed."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counters.value
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for _, _, texts in _chunks(batches):
            seen: set[tuple[int, int]] = set()
            found: list[list[np.ndarray]] = []
            for shingles in shingle_sets(texts, gram):
                n = len(shingles)
                cls = class_of(shingles)
                if not n or cls in seen:
                    continue
                seen.add(cls)
                often = counts[(shingles >> np.uint64(44)).astype(np.int64)]
                # Sorted by hash already: a stable sort by count leaves the hash to decide.
                first = np.argsort(often, kind="stable")[:prefix_length(n, percent)]
                size = len(first)
                found.append([shingles[first], np.full(size, cls[0], np.uint64),
                              np.full(size, cls[1], np.uint32), np.full(size, n, np.int32),
                              np.arange(size, dtype=np.int32),
                              often[first] // SPLIT])
            if not found:
                continue
            token, high, low, n, place, split = (np.concatenate(x) for x in zip(*found))
            salt = np.where(split > 0, high % (split.astype(np.uint64) + np.uint64(1)), 0)
            part = (mix(token + salt.astype(np.uint64) * _SALT) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            out_part, blobs = [], []
            columns = [token, high, low, n, place, (split > 0).astype(np.uint8)]
            for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                out_part.append(int(part[own[0]]))
                blobs.append(squeeze(b"".join(c[own].tobytes() for c in columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_part, pa.int32()), pa.array(blobs, pa.binary())],
                names=["part", "blob"])
    return over


def _close(n: np.ndarray, m: np.ndarray, rest: np.ndarray, other: np.ndarray,
           percent: int) -> np.ndarray:
    """Length and positional filter of pairs: sizes, and shingles from the one met on."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (small * 100 >= large * percent) & (
        np.minimum(rest, other) * (100 + percent) >= percent * (n + m))


_MET = pa.schema([("token", pa.int64()), ("a", pa.binary()), ("b", pa.binary()),
                  ("n", pa.int64()), ("rest", pa.int64())])


def _candidates(percent: int, small: int):
    """One bucket: pairs (a, b) of classes, and the members (token, a, n, rest) of groups of
    which not all pairs are given."""
    def over(table: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[] for _ in _KINDS]
        width = sum(np.dtype(k).itemsize for k in _KINDS)
        for blob in table.column("blob").to_pylist():
            data = zstandard.ZstdDecompressor().decompress(blob)
            rows, at = len(data) // width, 0
            for part, kind in zip(parts, _KINDS):
                part.append(np.frombuffer(data, kind, rows, at))
                at += part[-1].nbytes
        token, high, low, n, place, split = (np.concatenate(p) for p in parts)
        order = np.lexsort((low, high, n, token))
        token, high, low = token[order], high[order], low[order]
        n, place, split = n[order].astype(np.int64), place[order].astype(np.int64), split[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        token, high, low, n, place, split = (
            x[fresh] for x in (token, high, low, n, place, split))
        rest = n - place
        head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(head, len(token)))
        group = np.repeat(np.arange(len(head)), size)
        big = (size > small) | (split[head] > 0)
        left, right = [], []
        for step in range(1, small):
            i = np.flatnonzero((group[step:] == group[:-step]) & ~big[group[step:]])
            if not len(i):
                break
            keep = _close(n[i], n[i + step], rest[i], rest[i + step], percent)
            left.append(i[keep])
            right.append(i[keep] + step)
        members = np.flatnonzero(big[group])
        own = group[members]
        for k in range(PIVOTS if len(members) else 0):
            # The least by a hash of the class: groups that share members share pivots too.
            rank = mix(high[members] ^ _SALT ^ np.uint64(k))
            order = np.lexsort((rank, own))
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            pivot = np.repeat(members[order[heads]], np.diff(np.append(heads, len(members))))
            keep = (pivot != members) & _close(n[members], n[pivot], rest[members], rest[pivot],
                                               percent)
            left.append(members[keep])
            right.append(pivot[keep])
        # A bucket in which no two sets meet gives no pairs.
        none = np.empty(0, np.int64)
        left, right = np.concatenate([none, *left]), np.concatenate([none, *right])
        names = [_name(h, w) for h, w in zip(high.tolist(), low.tolist())] if len(left) or len(
            members) else []
        pairs = {(min(names[i], names[j]), max(names[i], names[j]))
                 for i, j in zip(left.tolist(), right.tolist())}
        a, b = zip(*pairs) if pairs else ((), ())
        none = [None] * len(a)
        return pa.Table.from_arrays(
            [pa.array(none + token[members].view(np.int64).tolist(), pa.int64()),
             pa.array([*a, *(names[i] for i in members.tolist())], pa.binary()),
             pa.array([*b, *[None] * len(members)], pa.binary()),
             pa.array(none + n[members].tolist(), pa.int64()),
             pa.array(none + rest[members].tolist(), pa.int64())], schema=_MET)
    return over


def _profiles(column) -> tuple[np.ndarray, np.ndarray]:
    """Profiles as rows, and which are missing."""
    blobs = column.to_pylist()
    missing = np.array([not p for p in blobs], bool)
    rows = np.frombuffer(b"".join(p or bytes(RANGES) for p in blobs), np.uint8)
    return rows.reshape(-1, RANGES), missing


def _may_link(x: np.ndarray, y: np.ndarray, missing: np.ndarray, n: np.ndarray,
              percent: int) -> np.ndarray:
    """Suffix filter: the overlap of two sets is at most that of their counts in each range.

    n: the sum of their sizes. Sets without a profile pass."""
    bound = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return missing | (bound * (100 + percent) >= percent * n)


def _suffix(percent: int):
    """Drops pairs whose counts over hash ranges bound the overlap too low."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            (x, no_x), (y, no_y) = _profiles(batch.column("pa")), _profiles(batch.column("pb"))
            keep = _may_link(x, y, no_x | no_y, na + nb, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return over


def _across(percent: int):
    """Pairs of one shingle's members in different components that pass all three filters.

    Rows of block i meet rows of block j (all rows, once each, if i = j)."""
    def over(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        names, root = table.column("a").to_pylist(), table.column("root").to_pylist()
        numbers = {r: k for k, r in enumerate(dict.fromkeys(root))}
        root = np.array([numbers[r] for r in root])
        n, rest = table.column("n").to_numpy(), table.column("rest").to_numpy()
        profile, missing = _profiles(table.column("profile"))
        mine = np.flatnonzero(block == i)
        theirs = np.flatnonzero(block == j)
        out = []
        for k, x in enumerate(mine.tolist()):
            ys = theirs[k + 1:] if i == j else theirs
            ys = ys[(root[ys] != root[x]) & _close(n[x], n[ys], rest[x], rest[ys], percent)]
            if len(ys):
                ys = ys[_may_link(profile[x], profile[ys], missing[x] | missing[ys],
                                  n[x] + n[ys], percent)]
                out += [(min(names[x], names[y]), max(names[x], names[y])) for y in ys.tolist()]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return over


def _set_bytes(gram: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            blobs = [s.tobytes() for k in range(0, len(texts), 256)
                     for s in shingle_sets(texts[k:k + 256], gram)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), pa.array(blobs, pa.binary())], names=["cls", "shingles"])
    return over


def _verify(percent: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return over


def components(links: DataFrame) -> DataFrame:
    """node, root for the connected components of links (a, b), root being the least node.

    Alternates large-star and small-star steps until nothing changes; every step is a grouped
    minimum and a join, and is stored.
    """
    edges = written(links.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc_edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = written(large, "cc_large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = written(small, "cc_small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT,
                    small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc, tag, n, cls, root, component_id for every row of ``docs`` (doc_id, text).

    tag is the text's hash, cls names the set of shingles, root the component of sets. Prefix groups of up to ``small`` are
    compared all with all; ``block`` members of a larger one meet in a task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("tag"),
                       "text")
    seen = written(rows.mapInArrow(
        _describe(gram), "doc bigint, tag bigint, n bigint, cls binary, profile binary, "
        "piece int, counts binary"), "shingle_rows")
    # The counters: COUNTERS numbers at any input size.
    counters = np.zeros((COUNTERS // PIECE, PIECE), np.int32)
    for r in seen.filter("piece is not null").select("piece", "counts").groupBy(
            "piece").applyInArrow(_add_up, "piece int, counts binary").toLocalIterator():
        counters[r.piece] = np.frombuffer(r.counts, np.int32)
    shared = spark.sparkContext.broadcast(counters.reshape(-1))
    described = seen.filter("piece is null").drop("piece", "counts")
    total, prefix = described.agg(F.count("*"), F.sum(
        F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()

    classes = described.groupBy("cls").agg(
        F.first("n").alias("n"), F.first("profile").alias("profile"),
        F.count("*").alias("copies"), F.min("doc").alias("least"),
        F.min(F.struct(F.col("doc").isNull(), F.col("doc"), F.col("tag"))).alias("at"))
    classes = written(classes, "shingle_classes")

    parts = partitions_for(docs, prefix or 0, BUCKET)
    met = rows.mapInArrow(_prefixes(gram, parts, shared, percent), "part int, blob binary").groupBy(
        "part").applyInArrow(_candidates(percent, small),
                             "token bigint, a binary, b binary, n bigint, rest bigint")
    met = written(met, "prefix_met")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Verifies each pair once, against whole sets."""
        pairs = written(pairs, name)
        used = pairs.select(F.col("a").alias("cls")).unionByName(
            pairs.select(F.col("b").alias("cls"))).distinct()
        at = classes.join(used, "cls").select("cls", "at.doc", "at.tag")
        same = rows["doc"].eqNullSafe(at["doc"]) & (rows["tag"] == at["tag"])
        sets = rows.join(at.hint("shuffle_hash"), same).select("cls", "text").mapInArrow(
            _set_bytes(gram), "cls binary, shingles binary")
        sets = written(sets, name + "_sets").dropDuplicates(["cls"])
        joined = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")),
                            "a").join(
            sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b")
        return written(joined.select("a", "b", "sa", "sb").mapInArrow(
            _verify(percent), "a binary, b binary"), name + "_links")

    def side(x: str) -> DataFrame:
        return classes.select(F.col("cls").alias(x), F.col("n").alias("n" + x),
                              F.col("profile").alias("p" + x))

    pairs = met.filter("b is not null").select("a", "b").distinct().join(side("a"), "a").join(
        side("b"), "b").mapInArrow(_suffix(percent), "a binary, b binary")
    links = verified(pairs, "near_pairs")
    roots = written(components(links), "near_roots")

    # Members of large groups whose components differ.
    large = met.filter("b is null").select("token", "a", "n", "rest").join(
        roots.select(F.col("node").alias("a"), "root"), "a", "left").withColumn(
        "root", F.coalesce("root", "a"))
    large = written(large, "near_large")
    mixed = large.groupBy("token", "root").agg(F.count("*").alias("own")).groupBy("token").agg(
        F.sum("own").alias("members"), F.max("own").alias("most"),
        F.max_by("root", F.struct("own", "root")).alias("main"))
    mixed = written(mixed.filter("most < members"), "near_mixed")
    if mixed.take(1):
        count = large.count()
        inside = large.join(mixed.select("token"), "token", "left_semi")
        dealt = join_groups(written(inside, "near_inside"), mixed, ["token"], "members", count)
        # The largest component's members need not meet each other: blocks 0..k-1 hold the
        # others, which meet all, blocks k..k+m-1 hold its members, which meet the others.
        k = F.ceil((F.col("members") - F.col("most")) / block).cast("int")
        m = F.ceil(F.col("most") / block).cast("int")
        inner = F.col("root") == F.col("main")
        dealt = dealt.withColumn("block", F.when(inner, k + F.pmod(F.xxhash64("a"), m)).otherwise(
            F.pmod(F.xxhash64("a"), k)).cast("int"))
        dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.when(inner, k - 1).otherwise(
            k + m - 1))).alias("o"))
        dealt = dealt.withColumn("i", F.least("block", "o")).withColumn(
            "j", F.greatest("block", "o")).join(
            classes.select(F.col("cls").alias("a"), "profile"), "a")
        more = dealt.select("token", "i", "j", "block", "a", "root", "n", "rest",
                            "profile").groupBy("token", "i", "j").applyInArrow(
            _across(percent), "a binary, b binary").distinct()
        again = verified(more, "near_more")
        roots = written(components(links.unionByName(again)), "near_roots")

    sized = classes.select("cls", "copies", "least").join(
        roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    sized = written(sized, "near_sized")
    lowest = sized.groupBy("root").agg(F.min("least").alias("component_id"),
                                       F.count("*").alias("classes"))
    named = join_groups(sized, written(lowest, "near_lowest"), ["root"], "classes", total)
    named = written(named.select("cls", "copies", "root", "component_id"), "near_named")
    return join_groups(described, named, ["cls"], "copies", total).withColumn(
        "component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")))


def join_near(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, small: int = SMALL,
              block: int = BLOCK) -> DataFrame:
    """Contract of op10, one row per document: doc_id, n_shingles, component_id.

    Null, empty and blank texts have no shingles and are their own component. A null doc_id is
    larger than every other: it names a component only of rows without any id. Repeated rows are
    in one component; an empty table gives an empty result.
    """
    return near_duplicates(docs, gram, percent, small, block).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every component, the one with the smallest doc_id, with all its columns; all
    rows without shingles."""
    found = written(near_duplicates(docs).select("doc", "tag", "n", "root"), "near_found")
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "tag")
    best = found.filter("n > 0").groupBy("root").agg(F.min(order).alias("best")).select(
        F.col("best.doc").alias("doc"), F.col("best.tag").alias("tag"))
    copies = found.filter("n > 0").groupBy("doc", "tag").agg(F.count("*").alias("copies"))
    copies = copies.withColumnsRenamed({"doc": "_doc", "tag": "_tag"})
    best = best.join(copies, F.col("doc").eqNullSafe(F.col("_doc")) & (
        F.col("tag") == F.col("_tag"))).select("doc", "tag", "copies", F.lit(True).alias("one"))
    blank = found.filter("n = 0").groupBy("doc", "tag").agg(
        F.count("*").alias("copies"), F.lit(False).alias("one"))
    return keep_rows(docs, written(best.unionByName(blank), "near_kept"))


def oracle(gram: int = GRAM, percent: int = PERCENT) -> str:
    """DuckDB SQL of the links and their classes."""
    return rf"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct r, w[i:i + least({gram}, len(w)) - 1] as g from (
  select r, w, unnest(range(1, greatest(len(w) - {gram}, 0) + 2)) as i from d where len(w) > 0)),
n as (select r, count(*) as n from s group by r),
c as (select a.r as x, b.r as y, count(*) as k from s a join s b using (g) where a.r <> b.r
  group by all),
l as (select x, y from c join n a on a.r = x join n b on b.r = y
  where 100 * k >= {percent} * (a.n + b.n - k)),
reach(x, y) as (select r, r from n union select reach.x, l.y from reach join l on l.x = reach.y)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles,
  coalesce(min(o.doc_id), d.doc_id) as component_id
from d left join n using (r) left join reach on reach.x = d.r left join d o on o.r = reach.y
group by d.r, d.doc_id
"""


ORACLE = oracle()

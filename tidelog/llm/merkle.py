"""Merkle manifest of a dataset, with leaf coordinates by bitmap rank.

A row's leaf is the digest of its columns. Per source, leaves stand in order of doc_id, and every
FAN neighbours become their parent until one node, the subroot, is left; the subroots become the
root in the same way. Nothing is sorted for that order:

* Every task turns its doc_ids into compressed bitmaps, a container per source and 65,536 ids (a
  list of 16-bit numbers where few are set). Containers are merged; each keeps how many rows it
  holds, and of ids on several rows how many. Prefix sums over containers, over groups of 65,536
  containers and over groups of those give where a container begins, so no sum runs over more
  than 65,536 rows of one group, whatever the ids.
* A leaf's coordinate is its container's begin plus the rank of its id in the container: a popcount
  directory of the words before, and the popcount of the bits before it in its word.
* Leaves are dealt to keyed slot arrays of FAN ** LEVELS consecutive coordinates, which reduce by
  LEVELS levels at once; the nodes left are dealt again. So a source of any size is spread over
  its blocks, and three rounds are enough for 10^10 leaves. On the way back every block hands the
  siblings above it down to its nodes.

Identical rows travel once, with their number. Rows that share source and doc_id without being
identical are ordered by leaf, again by prefix sums over the digests' first two bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import join_groups, partitions_for
from tidelog.llm.crc import CRC_CTE, crc32_sql
from tidelog.sources.shared import written

#: Children of a node, levels that a block reduces at once, and rows of a task's blocks.
FAN, LEVELS, TASK = 3, 7, 100_000
BLOCK = FAN ** LEVELS
#: Ids of a container, as a power of two; fewer than DENSE of them are held as a list, which is
#: then shorter than the bitmap.
BITS, DENSE = 16, 4096
#: Copies of one row that are made in one task.
COPIES = 4096
#: Orders a null doc_id, after all others.
LAST = np.iinfo(np.int64).max


def digest_of(docs: DataFrame, text: Column) -> Column:
    """The digest of a row's columns with this text; each is its size and value, or ``-``."""
    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(*(field(c) for c in (
        F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """grp, key, doc, leaf, forged, n of the distinct rows; n is how many rows are alike.

    grp names the source and sorts as sources do (null first), key orders doc_ids; forged is the leaf
    after tampering where that changes it: with an even checksum of the doc_id the line ends go.
    """
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.col("text")
    rows = docs.select(
        F.when(F.col("source").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("="), F.col("source"))).alias("grp"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("key"),
        F.col("doc_id").cast("long").alias("doc"), digest_of(docs, text).alias("leaf"),
        F.when(even & text.contains("\n"), digest_of(docs, F.replace(
            text, F.lit("\n"), F.lit("")))).alias("forged"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def _container(low: np.ndarray) -> bytes:
    """Distinct 16-bit numbers, compressed: a sorted list, or a bitmap of 2^BITS bits."""
    if len(low) < DENSE:
        return np.sort(low).astype(np.uint16).tobytes()
    bits = np.zeros(1 << BITS, bool)
    bits[low] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _held(blob: bytes) -> np.ndarray:
    """The numbers in a container, in order."""
    if len(blob) < 1 << BITS - 3:
        return np.frombuffer(blob, np.uint16)
    return np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8), bitorder="little"))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of one batch, and the ids in them that are on several rows, with their number."""
    for batch in batches:
        table: dict[tuple[str, int], dict[int, int]] = {}
        for g, k, n in zip(*(batch.column(c).to_pylist() for c in ("grp", "key", "n"))):
            ids = table.setdefault((g, k >> BITS), {})
            low = k & (1 << BITS) - 1
            ids[low] = ids.get(low, 0) + n
        yield _containers([(g, high, np.fromiter(ids, np.int64, len(ids)),
                            np.fromiter(ids.values(), np.int64, len(ids)))
                           for (g, high), ids in table.items()])


_CONTAINER = pa.schema([("grp", pa.string()), ("high", pa.int64()), ("rows", pa.int64()),
                        ("ids", pa.binary()), ("many", pa.binary()), ("times", pa.binary())])
_CONTAINER_DDL = "grp string, high bigint, rows bigint, ids binary, many binary, times binary"


def _containers(found: list[tuple[str, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    out = []
    for g, high, low, times in found:
        many = np.flatnonzero(times > 1)
        many = many[np.argsort(low[many])]
        out.append((g, high, int(times.sum()), _container(low), low[many].astype(np.uint16).tobytes(),
                    times[many].tobytes()))
    columns = list(zip(*out)) if out else [()] * len(_CONTAINER)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, f.type) for v, f in zip(columns, _CONTAINER)], schema=_CONTAINER)


def _merge(table: pa.Table) -> pa.Table:
    """Partial containers of some (grp, high) to one each."""
    met: dict[tuple[str, int], list[tuple]] = {}
    for g, high, *blobs in zip(*(table.column(c).to_pylist() for c in (
            "grp", "high", "ids", "many", "times"))):
        met.setdefault((g, high), []).append(tuple(blobs))
    found = []
    for (g, high), blobs in met.items():
        low = np.concatenate([_held(b[0]) for b in blobs]).astype(np.int64)
        more = np.concatenate([np.frombuffer(b[1], np.uint16) for b in blobs]).astype(np.int64)
        times = np.concatenate([np.frombuffer(b[2], np.int64) for b in blobs]) - 1
        if len(low) > DENSE:
            counts = np.bincount(low, minlength=1 << BITS)
            np.add.at(counts, more, times)
            low = np.flatnonzero(counts)
            found.append((g, high, low, counts[low]))
        else:
            low, counts = np.unique(low, return_counts=True)
            np.add.at(counts, np.searchsorted(low, more), times)
            found.append((g, high, low, counts))
    return pa.Table.from_batches([_containers(found)])


class Ranks:
    """Rank queries on one container: rows before an id, in the container."""

    def __init__(self, ids: bytes, many: bytes, times: bytes) -> None:
        held = _held(ids)
        self.words = np.zeros(1 << BITS - 6, np.uint64)
        np.bitwise_or.at(self.words, held >> 6, np.uint64(1) << (held & 63).astype(np.uint64))
        self.directory = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.many = np.frombuffer(many, np.uint16)
        self.times = np.frombuffer(times, np.int64)
        self.more = np.concatenate(([0], np.cumsum(self.times - 1)))

    def rank(self, low: np.ndarray) -> np.ndarray:
        word, bit = low >> 6, (low & 63).astype(np.uint64)
        before = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return (self.directory[word] + np.bitwise_count(before)
                + self.more[np.searchsorted(self.many, low)])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tree, n, grp, key, first, total of the ids on several rows; first is their first coordinate."""
    schema = pa.schema([("tree", pa.int64()), ("size", pa.int64()), ("grp", pa.string()),
                        ("key", pa.int64()), ("first", pa.int64()), ("total", pa.int64())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["many"]:
                at = Ranks(r["ids"], r["many"], r["times"])
                low = at.many.astype(np.int64)
                first = at.rank(low) + r["begin"]
                out += [(r["tree"], r["size"], r["grp"], (r["high"] << BITS) + int(a), int(b), int(c))
                        for a, b, c in zip(low, first, at.times)]
        columns = list(zip(*out)) if out else [()] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)


_NODE_DDL = "tree bigint, size bigint, idx bigint, doc bigint, leaf binary, forged binary"
_NODE = pa.schema([("tree", pa.int64()), ("size", pa.int64()), ("idx", pa.int64()),
                   ("doc", pa.int64()), ("leaf", pa.binary()), ("forged", pa.binary())])


def _place(rows: pa.Table, containers: pa.Table) -> pa.Table:
    """Leaves of some containers with their coordinates, by rank queries."""
    known = {(r["grp"], r["high"]): r for r in containers.to_pylist()}
    key = rows.column("key").to_numpy()
    mine: dict[tuple[str, int], list[int]] = {}
    for k, at in enumerate(zip(rows.column("grp").to_pylist(), (key >> BITS).tolist())):
        mine.setdefault(at, []).append(k)
    columns = np.empty((3, len(key)), np.int64)
    for at, place in mine.items():
        r = known[at]
        where = Ranks(r["ids"], r["many"], r["times"]).rank(key[place] & (1 << BITS) - 1)
        columns[0, place], columns[1, place] = r["tree"], r["size"]
        columns[2, place] = r["begin"] + where
    return pa.Table.from_arrays(
        [*(pa.array(c) for c in columns), *(rows.column(c) for c in ("doc", "leaf", "forged"))],
        schema=_NODE)


def _part(names: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int")


def _directories(containers: DataFrame) -> DataFrame:
    """grp, high, begin: the rows of a source before each container."""
    zero = F.lit(0).cast("bigint")
    at = containers.select("grp", "high", "rows", F.shiftright("high", 16).alias("a"),
                           F.shiftright("high", 32).alias("b"))

    def before(df: DataFrame, by: list[str], order: str, name: str) -> DataFrame:
        span = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("rows").over(span), zero))

    low = before(at, ["grp", "a"], "high", "p0")
    mid = at.groupBy("grp", "b", "a").agg(F.sum("rows").alias("rows"))
    top = at.groupBy("grp", "b").agg(F.sum("rows").alias("rows"))
    mid = before(mid, ["grp", "b"], "a", "p1").select("grp", "a", "p1")
    top = before(top, ["grp"], "b", "p2").select("grp", "b", "p2")
    return low.join(mid, ["grp", "a"]).join(top, ["grp", "b"]).select(
        "grp", "high", (F.col("p0") + F.col("p1") + F.col("p2")).alias("begin"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their number in order, as ``tree``: rows within ranges, ranges added up."""
    dealt = written(sources.repartitionByRange("grp").withColumn("p", F.spark_partition_id()),
                    "merkle_sources")
    inside = F.row_number().over(Window.partitionBy("p").orderBy("grp")).cast("bigint")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    # A row per shuffle partition.
    begin = dealt.groupBy("p").agg(F.count("*").alias("c")).withColumn(
        "begin", F.coalesce(F.sum("c").over(before), F.lit(0).cast("bigint"))).drop("c")
    return dealt.withColumn("i", inside).join(begin, "p").select(
        "grp", "size", (F.col("begin") + F.col("i") - 1).alias("tree"))


def coordinates(found: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """The leaves as nodes (tree, size, idx, doc, leaf, forged), a row per row of the table, and
    the trees (grp, tree, size). ``found``: stored leaves; ``total``: their rows."""
    parts = partitions_for(found, total, TASK)
    containers = found.select("grp", "key", "n").mapInArrow(_partial, _CONTAINER_DDL).withColumn(
        "part", _part(["grp", "high"], parts)).groupBy("part").applyInArrow(_merge, _CONTAINER_DDL)
    containers = written(containers, "merkle_containers")
    trees = written(_numbered(containers.groupBy("grp").agg(F.sum("rows").alias("size"))),
                    "merkle_trees")
    counted = containers.join(_directories(containers), ["grp", "high"])
    counted = written(join_groups(
        written(counted, "merkle_begins"), trees, ["grp"], "size", total), "merkle_directory")
    repeated = written(counted.mapInArrow(
        _repeated, "tree bigint, size bigint, grp string, key bigint, first bigint, total bigint"),
        "merkle_repeated")
    some = bool(repeated.take(1))
    single = found
    if some:
        keys = repeated.select("grp", "key", "total")
        limit = max(1, total // 4096)
        # Fewer than 4,096 ids hold more rows than that.
        single = found.join(F.broadcast(keys.filter(F.col("total") > limit)), ["grp", "key"],
                            "left_anti").join(keys, ["grp", "key"], "left_anti")
    left = single.withColumn("high", F.shiftright("key", BITS)).withColumn(
        "part", _part(["grp", "high"], parts)).drop("high")
    placed = left.groupBy("part").cogroup(counted.withColumn(
        "part", _part(["grp", "high"], parts)).groupBy("part")).applyInArrow(_place, _NODE_DDL)
    if some:
        placed = placed.unionByName(_copies(found, repeated, total))
    return written(placed, "merkle_nodes"), trees


def _copies(found: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """Nodes of rows whose id is on several rows: by leaf, alike rows in a row."""
    rows = written(join_groups(found, repeated, ["grp", "key"], "total", total), "merkle_copies")
    rows = rows.withColumn("r", F.substring("leaf", 1, 2))
    zero = F.lit(0).cast("bigint")
    to_here = (Window.unboundedPreceding, -1)
    ranges = rows.groupBy("grp", "key", "r").agg(F.sum("n").alias("c")).withColumn(
        "p0", F.coalesce(F.sum("c").over(Window.partitionBy("grp", "key").orderBy("r").rowsBetween(
            *to_here)), zero)).drop("c")
    rows = rows.withColumn("p1", F.coalesce(F.sum("n").over(Window.partitionBy(
        "grp", "key", "r").orderBy("leaf").rowsBetween(*to_here)), zero)).join(
        ranges, ["grp", "key", "r"])
    step = F.lit(COPIES).cast("bigint")
    rows = rows.withColumn("at", F.col("first") + F.col("p0") + F.col("p1")).withColumn(
        "k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / step))))
    rows = rows.repartition("grp", "key", "leaf", "k").withColumn("k", F.explode(F.sequence(
        F.col("k") * step, F.least((F.col("k") + 1) * step, F.col("n")) - 1)))
    return rows.select("tree", "size", (F.col("at") + F.col("k")).alias("idx"), "doc", "leaf",
                       "forged")


def depth(size: int) -> int:
    """Levels from ``size`` nodes to one."""
    levels = 0
    while size > 1:
        size = -(-size // FAN)
        levels += 1
    return levels


def _lift(nodes: list[bytes]) -> list[bytes]:
    return [sha256(b"".join(nodes[k:k + FAN])).hexdigest().encode()
            for k in range(0, len(nodes), FAN)]


def _slots(table: pa.Table) -> Iterator[tuple[int, int, int, np.ndarray, list[bytes]]]:
    """Per block: tree, its size, the block's number, its rows by slot, and its hex digests."""
    tree, size, idx = (table.column(c).to_numpy() for c in ("tree", "size", "idx"))
    digests = table.column("leaf").to_pylist()
    blocks: dict[tuple[int, int], list[int]] = {}
    for k, at in enumerate(zip(tree.tolist(), (idx // BLOCK).tolist())):
        blocks.setdefault(at, []).append(k)
    for (t, b), rows in blocks.items():
        slots = np.empty(len(rows), np.int64)
        slots[idx[rows] % BLOCK] = rows
        yield t, int(size[rows[0]]), b, slots, [digests[k].hex().encode() for k in slots.tolist()]


def _up(table: pa.Table) -> pa.Table:
    """Blocks to their top nodes."""
    out = []
    for tree, size, block, _, nodes in _slots(table):
        for _ in range(min(LEVELS, depth(size))):
            nodes = _lift(nodes)
            size = -(-size // FAN)
        out.append((tree, size, block, bytes.fromhex(nodes[0].decode())))
    columns = list(zip(*out)) if out else [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
        names=["tree", "size", "idx", "leaf"])


def _siblings(nodes: list[bytes], levels: int) -> Iterator[tuple[int, list[bytes]]]:
    """Per slot, the digests beside its way up the block, level by level."""
    heights = [nodes]
    for _ in range(levels):
        heights.append(_lift(heights[-1]))
    for slot in range(len(nodes)):
        beside, at = [], slot
        for height in heights[:levels]:
            run = at - at % FAN
            beside += height[run:at] + height[at + 1:run + FAN]
            at //= FAN
        yield slot, beside


def _down(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Nodes of blocks with the siblings on the rest of their way, from those of their block."""
    known = {(t, i): (p, s) for t, i, p, s in zip(*(above.column(c).to_pylist() for c in (
        "tree", "idx", "path", "subroot")))}
    out = []
    for tree, size, block, _, digests in _slots(nodes):
        path, subroot = known[tree, block]
        for slot, beside in _siblings(digests, min(LEVELS, depth(size))):
            out.append((tree, block * BLOCK + slot,
                        bytes.fromhex(b"".join(beside).decode()) + path, subroot))
    columns = list(zip(*out)) if out else [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
        names=["tree", "idx", "path", "subroot"])


def fold(digest: bytes, beside: list[bytes], idx: int, size: int, above: int, sources: int) -> bytes:
    """The root that a hex leaf gives with its hex siblings: leaf ``idx`` of ``size``, then source
    ``above`` of ``sources``."""
    k = 0
    for at, count in ((idx, size), (above, sources)):
        while count > 1:
            run = min(FAN, count - (at - at % FAN))
            left, right = at % FAN, run - 1 - at % FAN
            digest = sha256(b"".join([*beside[k:k + left], digest, *beside[
                k + left:k + left + right]])).hexdigest().encode()
            k += run - 1
            at, count = at // FAN, -(-count // FAN)
    return digest


def _prove(sources: int, root: str):
    """Leaves of blocks to the contract's rows."""
    def over(nodes: pa.Table, above: pa.Table) -> pa.Table:
        known = {(t, i): (p, s) for t, i, p, s in zip(*(above.column(c).to_pylist() for c in (
            "tree", "idx", "path", "subroot")))}
        docs, forged = nodes.column("doc").to_pylist(), nodes.column("forged").to_pylist()
        out = []
        for tree, size, block, rows, digests in _slots(nodes):
            path, subroot = known[tree, block]
            rest = path.hex().encode()
            upper = [rest[k:k + 64] for k in range(0, len(rest), 64)]
            for slot, beside in _siblings(digests, min(LEVELS, depth(size))):
                row = int(rows[slot])
                leaf = digests[slot] if forged[row] is None else forged[row].hex().encode()
                again = fold(leaf, beside + upper, block * BLOCK + slot, size, tree, sources).decode()
                out.append((docs[row], digests[slot].decode(), subroot.hex(), root,
                            sha256(b"".join(beside) + rest).hexdigest(), again, again == root))
        columns = list(zip(*out)) if out else [()] * len(_PROOF)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PROOF)],
                                    schema=_PROOF)
    return over


_PROOF = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in (
    "leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])
_PROOF_DDL = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean")


def reduce_trees(nodes: DataFrame, largest: int, total: int, name: str) -> list[DataFrame]:
    """Nodes (tree, size, idx, leaf) round by round, from these to one node per tree, stored."""
    rounds = [nodes]
    while largest > 1:
        parts = partitions_for(nodes, total, TASK)
        top = rounds[-1].select("tree", "size", "idx", "leaf").withColumn(
            "blk", F.floor(F.col("idx") / BLOCK)).withColumn("part", _part(["tree", "blk"], parts))
        rounds.append(written(top.drop("blk").groupBy("part").applyInArrow(
            _up, "tree bigint, size bigint, idx bigint, leaf binary"), name))
        for _ in range(LEVELS):
            largest = -(-largest // FAN)
        total = -(-total // BLOCK)
    return rounds


def _handed(nodes: DataFrame, above: DataFrame, total: int, over, ddl: str) -> DataFrame:
    """Blocks of nodes with what is above them."""
    parts = partitions_for(nodes, total, TASK)
    blocks = nodes.withColumn("blk", F.floor(F.col("idx") / BLOCK)).withColumn(
        "part", _part(["tree", "blk"], parts)).drop("blk")
    above = above.withColumn("part", _part(["tree", "idx"], parts))
    return blocks.groupBy("part").cogroup(above.groupBy("part")).applyInArrow(over, ddl)


_PATH_DDL = "tree bigint, idx bigint, path binary, subroot binary"


def prove_rows(docs: DataFrame) -> DataFrame:
    """Contract of op13, one row per document: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    Null columns count as ``-``; a null doc_id comes after all others of its source and is never
    tampered with; a null source comes first. Rows with one source and doc_id are ordered by leaf.
    A single row is its own subroot and root, with an empty proof. An empty table gives an empty
    result.
    """
    found = written(leaves(docs), "merkle_leaves")
    total = found.agg(F.sum("n")).first()[0] or 0
    if not total:
        return docs.sparkSession.createDataFrame([], _PROOF_DDL)
    nodes, trees = coordinates(found, total)
    sources, largest = trees.agg(F.count("*"), F.max("size")).first()
    rounds = reduce_trees(nodes, largest, total, "merkle_up")
    # Every tree's one node is a node of the tree of sources.
    subroots = rounds[-1].select(F.lit(0).cast("bigint").alias("tree"), F.lit(sources).cast(
        "bigint").alias("size"), F.col("tree").alias("idx"), "leaf")
    tops = reduce_trees(written(subroots, "merkle_subroots"), sources, sources, "merkle_top")
    root = tops[-1].first().leaf
    none = F.lit(b"")
    path = tops[-1].select("tree", "idx", none.alias("path"), none.alias("subroot"))
    for level in tops[-2::-1]:
        path = written(_handed(level.select("tree", "size", "idx", "leaf"), path, sources, _down,
                               _PATH_DDL), "merkle_path")
    path = path.join(rounds[-1].select(F.col("tree").alias("idx"), F.col("leaf")), "idx").select(
        F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "path",
        F.col("leaf").alias("subroot"))
    above = written(path, "merkle_path")
    for level in rounds[-2:0:-1]:
        above = written(_handed(level, above, total, _down, _PATH_DDL), "merkle_path")
    return _handed(nodes, above, total, _prove(int(sources), bytes(root).hex()), _PROOF_DDL)


def _sql_field(x: str) -> str:
    return f"case when {x} is null then '-' else strlen({x}::varchar) || ':' || {x}::varchar end"


_SQL_HEAD = " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
ORACLE = rf"""
with recursive {CRC_CTE},
c as (select row_number() over () as r, *, {crc32_sql("coalesce(doc_id::varchar, 'x')")} as h
  from documents, crc),
e as (select r, doc_id, source, sha256({_SQL_HEAD} || {_sql_field("text")}) as leaf,
  case when doc_id is not null and h % 2 = 0 then sha256({_SQL_HEAD}
  || {_sql_field("replace(text, chr(10), '')")}) end as forged from c),
l as (select *, dense_rank() over (order by source nulls first) - 1 as tree,
  row_number() over (partition by source order by coalesce(doc_id, {LAST}), leaf, r) - 1 as idx,
  count(*) over (partition by source) as size from e),
low as (select tree, 0 as lvl, idx, size, leaf as dig from l union all
  select tree, lvl + 1, idx // {FAN}, (size + {FAN - 1}) // {FAN},
  sha256(string_agg(dig, '' order by idx)) from low where size > 1
  group by tree, lvl, size, idx // {FAN}),
sub as (select tree, dig from low where size = 1),
high as (select 0 as lvl, tree as idx, (select count(*) from sub) as size, dig from sub union all
  select lvl + 1, idx // {FAN}, (size + {FAN - 1}) // {FAN}, sha256(string_agg(dig, '' order by idx))
  from high where size > 1 group by lvl, size, idx // {FAN}),
top as (select dig as root from high where size = 1),
nodes as (select tree, lvl, idx, dig from low where size > 1 union all
  select -1, 1000 + lvl, idx, dig from high where size > 1),
beside as (select a.tree, a.lvl, a.idx,
  coalesce(string_agg(o.dig, '' order by o.idx) filter (o.idx < a.idx), '') as before,
  coalesce(string_agg(o.dig, '' order by o.idx) filter (o.idx > a.idx), '') as after
  from nodes a join nodes o on o.tree = a.tree and o.lvl = a.lvl and o.idx // {FAN} = a.idx // {FAN}
  group by all),
way as (select r, row_number() over (partition by r order by lvl) as k, before, after from (
  select r, lvl, before, after from l join beside b on b.tree = l.tree
  and b.idx = l.idx // ({FAN} ** b.lvl)::bigint where b.lvl < 1000 union all
  select r, lvl, before, after from l join beside b on b.tree = -1
  and b.idx = l.tree // ({FAN} ** (b.lvl - 1000))::bigint)),
proof as (select r, sha256(coalesce(string_agg(before || after, '' order by k), '')) as proof,
  count(k) as last from l left join way using (r) group by r),
folded as (select r, 0 as k, coalesce(forged, leaf) as dig from l union all
  select folded.r, way.k, sha256(before || dig || after)
  from folded join way on way.r = folded.r and way.k = folded.k + 1)
select doc_id, leaf, sub.dig as subroot, root, proof as proof_sha256, f.dig as folded_root,
  f.dig = root as verified
from l join sub using (tree) join proof using (r) join folded f on f.r = l.r and f.k = last, top
"""

"""Sharding by a lookup table that permutations of the shards fill.

Every shard has its own permutation of the slots of a prime-sized table. The shards take turns;
in its turn a shard claims the first slot of its permutation that is still free. A document's
digest gives a slot, and the slot its shard: constant time, within one slot of even, and adding
or removing a shard moves few slots besides its own.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shards and slots of the registered query; the table has SLOTS rows at any input size.
SHARDS, SLOTS = 64, 16381


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill(names: list[str], slots: int) -> list[int]:
    """The shard (its place in ``names``) of every slot; ``slots`` is prime, not below len(names)."""
    if not names or len(names) > slots or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("needs 1 to `slots` shards and a prime number of slots")
    place = [_number(f"offset:{x}") % slots for x in names]
    step = [_number(f"skip:{x}") % (slots - 1) + 1 for x in names]
    owner, left = [-1] * slots, slots
    while True:
        for k in range(len(names)):
            while owner[place[k]] >= 0:
                place[k] = (place[k] + step[k]) % slots
            owner[place[k]] = k
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, names: list[str], slots: int) -> DataFrame:
    """slot, shard: the filled table; its size is the parameter ``slots``."""
    text = ",".join(map(str, fill(names, slots)))
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard")).select(
        F.col("slot").cast("long"), F.col("shard").cast("int"))


def slot_of(key, slots: int):
    """Slot of a key: 60 bits of its MD5 modulo the number of slots; null counts as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def shard_documents(docs: DataFrame, names: list[str], slots: int) -> DataFrame:
    """doc_id, slot, shard for every row. Null ids go to the slot of the empty string, repeated
    rows to the same shard; an empty table gives an empty result."""
    table = lookup_table(docs.sparkSession, names, slots)
    return docs.select("doc_id", slot_of(F.col("doc_id"), slots).alias("slot")).join(
        F.broadcast(table), "slot").select("doc_id", "slot", "shard")


def shard_names(count: int) -> list[str]:
    return [f"shard-{k:04d}" for k in range(count)]


def oracle(names: list[str], slots: int) -> str:
    """DuckDB SQL of the placement. The lookup table stands in it as values: that it is filled as
    the method says is held against a brute-force version in the tests."""
    table = ", ".join(f"({slot}, {shard})" for slot, shard in enumerate(fill(names, slots)))
    return f"""
with lookup(slot, shard) as (values {table}),
d as (select doc_id, ('0x' || left(md5(coalesce(doc_id::varchar, '')), 15))::bigint % {slots} as slot
  from documents)
select doc_id, slot, shard from d join lookup using (slot)
"""

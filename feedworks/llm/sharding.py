"""Sharding by a lookup table that the shards fill in turns.

Every shard has its own order of preference over the slots of a table, a permutation made of
a first slot and a step; the table's size is prime, so every step reaches all slots. The
shards take turns, each claiming the first slot of its order that is still
free. So all shards hold the same number of slots to one, and when a shard is added or
withdrawn few others' slots change hands. A row's key is hashed to a slot, and the
table, which depends on the shards alone, is sent to every task.

All steps on rows are DataFrame functions.

Defined results: the key of a row without doc_id is its text, so that such rows spread;
equal keys share a shard; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.llm.rows import text_of

#: Slots of the table: a prime, at least a hundred times the number of shards.
TABLE_SIZE = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(128))


def preference(shard: str, size: int) -> tuple[int, int]:
    """The first slot and the step of a shard's order of preference."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the number of the shard that holds it."""
    if size < 2 or any(size % n == 0 for n in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the size of the table must be prime, not {size}")
    if not shards or len(shards) > size:
        raise ValueError("there must be shards, and no more than slots")
    table = [-1] * size
    orders = [preference(shard, size) for shard in shards]
    wanted = [first for first, _ in orders]
    left = size
    while True:
        for number, (_, step) in enumerate(orders):
            slot = wanted[number]
            while table[slot] >= 0:
                slot = (slot + step) % size
            table[slot] = number
            wanted[number] = (slot + step) % size
            left -= 1
            if not left:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the first 60 bits of its MD5, modulo the size."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def table_frame(like: DataFrame, table: list[int], name: str) -> DataFrame:
    """The table as rows of slot and shard number, one per slot."""
    listed = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    return like.sparkSession.range(1).select(F.posexplode(listed).alias("slot", name))


def place(rows: DataFrame, key: Column, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE,
          name: str = "shard") -> DataFrame:
    """``rows`` with the slot of their key and the number of the shard that holds it. No shuffle."""
    table = table_frame(rows, fill_table(shards, size), name)
    return rows.withColumn("slot", slot_of(key, size)).join(F.broadcast(table), "slot")


def document_key(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("text:"), F.md5(text_of(docs))))


def place_documents(docs: DataFrame, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """Per document: doc_id, slot, its shard, and the shard it would have without the last one."""
    keyed = docs.select(docs["doc_id"].alias("doc_id"), document_key(docs).alias("key"))
    placed = place(keyed, F.col("key"), shards, size)
    fewer = table_frame(docs, fill_table(shards[:-1] or shards, size), "shard_without_last")
    return placed.join(F.broadcast(fewer), "slot").select("doc_id", "slot", "shard", "shard_without_last")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Write ``docs`` as Parquet, one folder ``shard=<number>`` each. Rows of a shard are
    dealt to as many tasks as their size asks for."""
    placed = place(docs, document_key(docs), shards, size).drop("slot")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)

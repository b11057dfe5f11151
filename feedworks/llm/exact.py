"""Exact duplicates by an extendible-hash index on shared files.

A text is known by the 64-bit hash of its normal form, its key. The index holds
an entry per distinct text. Its directory starts as one bucket of all keys and is
doubled as long as a bucket is overfull: each doubling tells keys apart by one bit
more, and only overfull buckets split. A bucket is a range of keys; the task that
owns it orders its entries and chains those that share a key. Texts that
share a key are compared byte for byte: rows count as copies only when their whole
normal forms are equal, and a key of different texts has a chain of entries.

Copies are added up where they are read, before anything moves, so a group may
hold any share of the rows.

Defined results: null text is empty; only A to Z change case; of rows that repeat
both doc_id and text exactly one stays; a group without any doc_id keeps one row and
has a null ``keep_id``; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import ROW, broadcast_if_small, lower_ascii, numbered, text_of

#: Keys a bucket holds before it splits, and the least number of bits that a directory may tell apart.
BUCKET_KEYS, LEAST_BITS = 4096, 16
#: Bits beyond those that as many buckets as the keys fill need, for buckets that are fuller than others.
_MORE_BITS = 4

Hash = Callable[[Column], Column]


def _normal_texts(docs: DataFrame, key: Hash) -> DataFrame:
    rows = numbered(docs, docs["doc_id"].alias("doc_id"), lower_ascii(text_of(docs)).alias("normal"))
    return rows.withColumn("key", key(F.col("normal")))


def directory_bits(n_keys: int, bucket_keys: int = BUCKET_KEYS) -> int:
    """The depth at which splitting ends, which grows with the number of keys."""
    return min(63, max(LEAST_BITS, math.ceil(math.log2(max(1, n_keys) / bucket_keys)) + _MORE_BITS))


def directory(keys: DataFrame, bits: int, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The bucket of each key prefix of so many bits that occurs in ``keys``.

    A prefix's depth is the number of doublings after which its bucket holds no
    more than ``bucket_keys`` keys.
    """
    counts = keys.groupBy(_prefix(bits).alias("prefix")).agg(F.count("*").alias("keys"))
    levels = counts.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(bits))))
    levels = levels.withColumn("bucket", F.expr(f"shiftright(prefix, {bits} - depth)"))
    held = levels.groupBy("depth", "bucket").agg(F.sum("keys").alias("held"))
    fits = (F.col("held") <= bucket_keys) | (F.col("depth") == bits)
    # A directory of the least size has at most 2 ** (LEAST_BITS + 1) nodes, which can be sent to every task.
    nodes = F.broadcast(held) if bits <= LEAST_BITS else held
    depths = (levels.join(nodes, ["depth", "bucket"]).filter(fits)
              .groupBy("prefix").agg(F.min("depth").alias("depth")))
    start = F.expr(f"shiftleft(shiftright(prefix, {bits} - depth), {bits} - depth)")
    return depths.select("prefix", "depth", start.alias("bucket"))


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("key", 64 - bits)


def build_index(docs: DataFrame, rows: DataFrame, key: Hash, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The index, written: bucket, key, chain (0, 1, ... among texts of one key),
    chains, keep_id and group_size, ordered by key within the file of each owner."""
    per_key = workspace.materialise(
        rows.groupBy("key").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")), "exact_keys")
    alone = per_key.filter("group_size = 1").select("key", "keep_id", "group_size", F.lit("").alias("text_sha256"))
    compared = _compare(_with_key_in(_normal_texts(docs, key), per_key.filter("group_size > 1").select("key")))
    compared = compared.join(alone, "key", "left_anti").select(alone.columns)
    entries = alone.unionByName(compared)
    bits = directory_bits(per_key.count(), bucket_keys)
    owned = (entries.withColumn("prefix", _prefix(bits)).join(directory(per_key, bits, bucket_keys), "prefix")
             .repartition("bucket").sortWithinPartitions("bucket", "key"))
    chain = Window.partitionBy("bucket", "key")
    return workspace.materialise(owned.select(
        "bucket", "key", "keep_id", "group_size",
        (F.row_number().over(chain.orderBy("text_sha256")) - 1).alias("chain"),
        F.count("*").over(chain).alias("chains")), "exact_index")


def _with_key_in(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts of the keys given, or of all keys if those are many: copies must be
    added up before a shuffle, which a join of whole texts on the key would be."""
    small = broadcast_if_small(keys)
    return texts if small is keys else texts.join(small, "key", "left_semi")


def _compare(texts: DataFrame) -> DataFrame:
    """One row per key and distinct text, equal bytes being one group."""
    groups = texts.groupBy("key", "normal").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return groups.withColumn("text_sha256", F.sha2("normal", 256))


def exact_groups(docs: DataFrame, key: Hash = F.xxhash64, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Per document: row identity, doc_id, keep_id, group_size, kept, text_sha256."""
    rows = workspace.materialise(
        _normal_texts(docs, key).select(*ROW, "doc_id", "key", F.sha2("normal", 256).alias("text_sha256")), "exact_rows")
    index = build_index(docs, rows, key, bucket_keys)
    found = rows.join(index.filter("chains = 1").select("key", "chain", "keep_id", "group_size"), "key")
    chained = index.filter("chains > 1").select("key").distinct()
    if not chained.isEmpty():
        found = found.unionByName(_follow_chains(docs, rows, chained, key).select(found.columns))
    found = workspace.materialise(found, "exact_found")
    stays = (found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("key", "chain").agg(F.min(F.struct(*ROW)).alias("row")).select("row.*", F.lit(True).alias("kept")))
    return found.join(stays, ROW, "left").select(
        *ROW, "doc_id", "keep_id", "group_size", F.coalesce("kept", F.lit(False)).alias("kept"), "text_sha256")


def _follow_chains(docs: DataFrame, rows: DataFrame, chained: DataFrame, key: Hash) -> DataFrame:
    """Rows whose key belongs to several texts, found by the text itself."""
    texts = _normal_texts(docs, key).join(broadcast_if_small(workspace.materialise(chained, "chained")), "key", "left_semi")
    order = Window.partitionBy("key").orderBy("text_sha256")
    entries = _compare(texts).withColumn("chain", F.row_number().over(order) - 1).drop("text_sha256")
    placed = texts.select(*ROW, "key", "normal").join(entries, ["key", "normal"]).drop("key", "normal")
    return rows.join(placed, ROW)

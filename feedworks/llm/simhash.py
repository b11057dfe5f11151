"""Near duplicates by SimHash, found in a Gray-order hierarchical index.

A document's fingerprint has 64 bits: bit by bit the majority among the XXH64 hashes
of its word shingles, repeats included. Fingerprints that differ in at most
:data:`MOST_BITS` bits are linked, and links make components.

Distinct fingerprints are sorted by Gray rank, the place of a code in the reflected
Gray sequence, so that neighbours differ in few bits. A block holds up to
:data:`BLOCK` neighbours, a node :data:`FAN` neighbouring blocks or nodes; of each the
index keeps the bits that all codes below it share, as pattern and mask.

1. Pairs of nodes go down the index level by level, as a frontier joined to the node
   table. A pair whose shared bits differ in more than the limit takes all the codes
   below it out of the search.
2. Each pair of blocks that is left meets in one task. There the second block carries on
   the hierarchy in groups of :data:`GROUP`. A node keeps only the bits that its parent
   hasn't, and each code of the first block adds up the differences on its way down.
3. Of the links a task finds it names those that join its codes, not all pairs.

The index is exact: nothing is sampled or cut off. Random codes in 2^m blocks meet the
sum of C(m, 0..4) of them, and that is how often a block is sent to a task.

Defined results: null text has no words; a document without words has fingerprint zero,
linked like any other; with fewer words than a shingle has, the whole sequence is one;
equal fingerprints are one code, however many rows have them; rows without doc_id don't
name a component unless all its rows are so (then it is null); no rows give no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedworks import workspace
from feedworks.llm.neardup import components
from feedworks.llm.rows import LOWER, UPPER, small_batches, text_of

SHINGLE_WORDS = 4
#: Bits in which linked fingerprints may differ.
MOST_BITS = 4
#: Codes of a block, blocks or nodes of a node, and codes or groups of a group within a block.
BLOCK, FAN, GROUP = 16_384, 16, 8
#: Shingles whose bits are counted at once, and codes that go down a block together.
_SHINGLES, _QUERIES = 1 << 15, 256
#: Pairs of blocks for each task of the search.
_PAIRS = 4

_SEED = 42
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def shingle_hashes(text: bytes) -> np.ndarray:
    """Hashes of the shingles of a text, in order, repeats included."""
    words = text.translate(_LOWER).split()
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), _SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][:len(words) - SHINGLE_WORDS + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[i:j], _SEED) for i, j in zip(starts.tolist(), ends[SHINGLE_WORDS - 1:].tolist())),
                       np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    set_in = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _SHINGLES):
        part = hashes[start:start + _SHINGLES].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(shift))
    return codes


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].cast(pa.large_binary())
        codes = np.array([fingerprint(shingle_hashes(text.as_py())) for text in texts], np.uint64)
        # With the first bit turned, signed numbers are in the order of the ranks.
        order = gray_rank(codes) ^ np.uint64(1 << 63)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(codes.view(np.int64)), pa.array(order.view(np.int64))], names=["doc_id", "code", "place"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, ``code`` (its fingerprint as a signed number) and ``place``,
    its Gray rank; written."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    with small_batches(docs.sparkSession):
        return workspace.materialise(rows.mapInArrow(_fingerprints, "doc_id long, code long, place long"), "simhash_rows")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted codes of a task."""
    kept = np.zeros(0, np.int64)
    more = iter(batches)
    while True:
        batch = next(more, None)
        if batch is not None:
            kept = np.r_[kept, batch["code"].to_numpy()]
        while len(kept) >= BLOCK or (batch is None and len(kept)):
            own, kept = kept[:BLOCK], kept[BLOCK:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own], pa.list_(pa.int64())), pa.array([np.bitwise_and.reduce(own)]), pa.array([np.bitwise_or.reduce(own)])],
                names=["codes", "every", "some"])
        if batch is None:
            return


def blocks(codes: DataFrame) -> DataFrame:
    """The distinct codes in Gray order, in blocks: ``node`` (numbered in that order),
    ``codes``, and the bits set in ``every`` and in ``some`` of them; written."""
    cut = (codes.orderBy("place").select("code").mapInArrow(_cut, "codes array<long>, every long, some long")
           .withColumn("at", F.monotonically_increasing_id()))
    cut = workspace.materialise(cut.withColumn("part", F.shiftright("at", 33)), "simhash_blocks")
    # A row per task, and the number of blocks that the tasks before it made.
    counts = cut.groupBy("part").agg(F.count("*").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return workspace.materialise(cut.join(counts, "part").select(place.alias("node"), "codes", "every", "some"), "simhash_nodes")


def _apart(one: str, other: str):
    """Bits in which all codes below one node differ from all those below another."""
    return F.bit_count((F.col(f"{one}.every").bitwiseAND(F.bitwise_not(F.col(f"{other}.some"))))
                       .bitwiseOR(F.col(f"{other}.every").bitwiseAND(F.bitwise_not(F.col(f"{one}.some")))))


def block_pairs(held: DataFrame) -> DataFrame:
    """The pairs of blocks that may hold linked codes: ``a`` <= ``b``; written."""
    levels = [held.select("node", "every", "some")]
    while (count := levels[-1].count()) > FAN:
        levels.append(workspace.materialise(levels[-1].groupBy(F.expr(f"node div {FAN}").alias("node")).agg(
            F.bit_and("every").alias("every"), F.bit_or("some").alias("some")), "simhash_nodes"))
    # All pairs among the few nodes at the top.
    frontier = levels[-1].select(F.col("node").alias("a"), F.explode(F.sequence("node", F.lit(max(count, 1) - 1))).alias("b"))
    for level, nodes in reversed(list(enumerate(levels))):
        if level < len(levels) - 1:
            below = nodes.select(F.expr(f"node div {FAN}").alias("above"), "node")
            frontier = (frontier.join(below.select(F.col("above").alias("a"), F.col("node").alias("x")), "a")
                        .join(below.select(F.col("above").alias("b"), F.col("node").alias("y")), "b")
                        .filter("x <= y").select(F.col("x").alias("a"), F.col("y").alias("b")))
        frontier = workspace.materialise(
            frontier.join(nodes.alias("one"), F.col("a") == F.col("one.node")).join(nodes.alias("two"), F.col("b") == F.col("two.node"))
            .filter(_apart("one", "two") <= MOST_BITS).select("a", "b"), "simhash_frontier")
    return frontier


class Index:
    """The hierarchy below a block. ``levels`` holds, from the top, pattern and own mask:
    the bits that a node's codes share and those of its parent don't. The last is the codes."""

    def __init__(self, codes: np.ndarray):
        shared = [(codes, np.full(len(codes), ~np.uint64(0)))]
        every, some = codes, codes
        while len(every) > GROUP:
            first = np.arange(0, len(every), GROUP)
            every, some = np.bitwise_and.reduceat(every, first), np.bitwise_or.reduceat(some, first)
            shared.append((every, ~(every ^ some)))
        self.levels = [shared[-1]]
        for (pattern, mask), (_, above) in zip(shared[-2::-1], shared[:0:-1]):
            self.levels.append((pattern, mask & ~np.repeat(above, GROUP)[:len(mask)]))

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of codes that differ in few enough bits."""
        pattern, mask = self.levels[0]
        query = np.repeat(np.arange(len(queries)), len(pattern))
        node = np.tile(np.arange(len(pattern)), len(queries))
        apart = np.zeros(len(node), np.uint8)
        for level, (pattern, mask) in enumerate(self.levels):
            if level:
                node = (node[:, None] * GROUP + np.arange(GROUP)).ravel()
                query, apart = np.repeat(query, GROUP), np.repeat(apart, GROUP)
                if len(node) and len(pattern) % GROUP:
                    there = node < len(pattern)
                    node, query, apart = node[there], query[there], apart[there]
            apart = apart + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node])
            alive = np.flatnonzero(apart <= MOST_BITS)
            node, query, apart = node[alive], query[alive], apart[alive]
        return query, node


def _join(labels: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Labels, each that of a row with itself as label, after joining rows in pairs."""
    while True:
        a, b = labels[one], labels[two]
        open_ = a != b
        if not open_.any():
            return labels
        one, two, a, b = one[open_], two[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def _links(one: np.ndarray, two: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Linked codes of two blocks, or of one block: each with the first code that it is
    joined to here."""
    codes = one if two is None else np.r_[one, two]
    index = Index((one if two is None else two).view(np.uint64))
    base, labels = 0 if two is None else len(one), np.arange(len(codes))
    for start in range(0, len(one), _QUERIES):
        query, node = index.near(one[start:start + _QUERIES].view(np.uint64))
        labels = _join(labels, query + start, node + base)
    joined = np.flatnonzero(labels != np.arange(len(codes)))
    return codes[joined], codes[labels[joined]]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one pair of blocks after another; the second of a pair follows the first."""
    waiting = None
    for batch in batches:
        codes = batch["codes"]
        for at, (a, b, second) in enumerate(zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["second"].to_pylist())):
            own = codes[at].values.to_numpy()
            if a != b and not second:
                waiting = own
                continue
            left, right = _links(own, None) if a == b else _links(waiting, own)
            if len(left):
                yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])


def links(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of codes that are linked, enough of them to make every component; written."""
    ends = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(False).alias("second"), F.col("a").alias("node")))).otherwise(
        F.array(F.struct(F.lit(False).alias("second"), F.col("a").alias("node")),
                F.struct(F.lit(True).alias("second"), F.col("b").alias("node"))))
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // _PAIRS))
    met = (pairs.select("a", "b", F.inline(ends)).join(held.select("node", "codes"), "node")
           .repartition(tasks, "a", "b").sortWithinPartitions("a", "b", "second"))
    with small_batches(pairs.sparkSession):
        return workspace.materialise(
            met.select("a", "b", "second", "codes").mapInArrow(_search, "a long, b long"), "simhash_links")


def similar_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, ``code`` (fingerprint as a signed number) and ``component_id``,
    the smallest doc_id that links lead to, its own included."""
    rows = fingerprints(docs)
    codes = workspace.materialise(rows.groupBy("code", "place").agg(F.min("doc_id").alias("least_id")), "simhash_codes")
    held = blocks(codes)
    labels = components(links(held, block_pairs(held)))
    members = labels.join(codes.select(F.col("code").alias("id"), "least_id"), "id")
    least = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = labels.join(least, "component").select(F.col("id").alias("code"), "component_id")
    known = workspace.materialise(
        codes.join(linked, "code", "left").select("code", F.coalesce("component_id", "least_id").alias("component_id")), "simhash_known")
    return rows.select("doc_id", "code").join(known, "code").select("doc_id", "code", "component_id")

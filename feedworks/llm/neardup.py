"""Near duplicates by b-bit MinHash, confirmed on full shingle sets.

A document is the set of its word shingles. Documents with the same set are one
class, worked on once. Each class gets 256 minima. They serve twice: four at
a time as 64 band keys, under which candidates meet, and by their low two bits,
packed into 64 bytes, from which the similarity of a candidate pair is estimated:
minima of different shingles agree in two bits by chance one time in four, which
is corrected for. Pairs that come near the limit are confirmed on their full sets.
At the limit of 0.75 a pair shares no band once in 4e10 cases, and the estimate
falls short by more than :data:`SLACK` less often than that.

Pairs within a bucket are never all formed:

1. Every member is paired with the smallest one, and links make components.
2. Where a bucket still holds several components, the members outside its largest one
   meet the members of other components in blocks. A task looks at the estimates of two
   blocks and names just enough pairs to connect all members that come near another.
   So connected, they make clusters.
3. Within a cluster, full sets meet in blocks in the same way, and a task names the
   links that join components.

Defined results: null text has no words; a document without words has no shingles
and is alone; with fewer words than a shingle has, the whole text is one; copies are
one class; of a component the row with the smallest doc_id, then the first in its
file, stays; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import AT, FILE, ROW, broadcast_if_small, in_small_batches, numbered, text_of
from feedworks.llm.wordhash import Words, chunks, mix

SHINGLE_WORDS = 5
#: Least similarity of linked documents, in hundredths.
LIMIT = 75
BANDS, BAND_ROWS = 64, 4
#: How far an estimate may lie below the limit before a pair is given up: six
#: standard deviations of an estimate from 256 minima.
SLACK = 0.21
#: Rows of a group that meet those of another block in one task.
BLOCK = 512

_HASHES = BANDS * BAND_ROWS
_A = (mix(np.arange(1, _HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1001, _HASHES + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
#: Shingles whose hashes are held at once while minima are taken.
_BLOCK = 4096


def shingle_sets(words: Words, n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per row of a chunk its set of shingles, sorted, as 64-bit hashes."""
    hashes = words.hashes()
    weights = mix(np.arange(5001, 5001 + n, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for i in range(n):
        whole += hashes[i:len(hashes) - n + 1 + i] * weights[i]
    whole = mix(whole)
    sets = []
    for low, high in zip(words.first[:-1], words.first[1:], strict=True):
        if high - low >= n:
            sets.append(np.unique(whole[low:high - n + 1]))
        elif high > low:
            short = (hashes[low:high] * weights[:high - low]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mix(short + np.uint64(high - low)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), _BLOCK):
        part = short[start:start + _BLOCK]
        np.minimum(least, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=least)
    return least


def low_bits(least: np.ndarray) -> np.ndarray:
    """Two low bits of each minimum, packed into 64-bit numbers."""
    pairs = (least & np.uint32(3)).astype(np.uint64).reshape(-1, 32)
    return np.bitwise_or.reduce(pairs << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=1)


def band_keys(least: np.ndarray) -> np.ndarray:
    parts = least.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        keys = mix(keys * np.uint64(0x100000001B3) + parts[:, i])
    return keys


_FEATURES = pa.schema([
    (FILE, pa.int64()), (AT, pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
    ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
    ("signature", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch["text"]):
            sets = shingle_sets(Words(data, offsets))
            numbers = np.array([[s.sum(dtype=np.uint64), mix(s ^ np.uint64(77)).sum(dtype=np.uint64)] for s in sets])
            least = [minima(s) if len(s) else None for s in sets]
            own = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([
                own[FILE], own[AT], own["doc_id"], own["text_key"], pa.array([len(s) for s in sets], pa.int64()),
                *(pa.array(column.view(np.int64)) for column in np.ascontiguousarray(numbers.T)),
                pa.array([[] if m is None else low_bits(m).view(np.int64) for m in least], pa.list_(pa.int64())),
                pa.array([[] if m is None else band_keys(m).view(np.int64) for m in least], pa.list_(pa.int64())),
            ], schema=_FEATURES)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch["text"]):
            sets = [s.view(np.int64) for s in shingle_sets(Words(data, offsets))]
            yield pa.RecordBatch.from_arrays(
                [batch["text_key"][first:last], pa.array(sets, pa.list_(pa.int64()))], names=["text_key", "shingles"])


def features(docs: DataFrame) -> DataFrame:
    """Row identity, doc_id, size and key of the set, signature and bands; written."""
    docs = in_small_batches(docs)
    text = text_of(docs)
    rows = numbered(docs, docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text)
    schema = (f"{FILE} long, {AT} long, doc_id long, text_key long, n_shingles long, set_a long, set_b long, "
              "signature array<long>, bands array<long>")
    return workspace.materialise(rows.mapInArrow(_features, schema), "near_features")


def classes(rows: DataFrame) -> DataFrame:
    """One row per set of shingles that occurs: its number ``id`` and the features of one of its documents."""
    first = (rows.filter("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
             .agg(F.min(F.struct(*ROW)).alias("row")).select("row.*"))
    return workspace.materialise(
        rows.join(first, ROW).withColumn("id", F.monotonically_increasing_id())
        .select("id", "set_a", "set_b", "n_shingles", "text_key", "signature", "bands"), "near_classes")


def _members(sets: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one class; written."""
    every = sets.select("id", "n_shingles", F.explode("bands").alias("bucket"))
    met = every.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("pivot")).filter("members > 1")
    # A written table: Spark can split a heavy bucket in this join, not in one that reuses the grouping.
    met = workspace.materialise(met.select("bucket", "pivot"), "near_buckets")
    return workspace.materialise(every.join(met, "bucket"), "near_members")


def _pair(one: str, other: str) -> list:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _sizes_fit(one: str, other: str):
    return 100 * F.least(one, other) >= LIMIT * F.greatest(one, other)


def _with_both(pairs: DataFrame, side: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with ``columns`` of either class, named ``<column>_a`` and ``<column>_b``."""
    for end in ("a", "b"):
        pairs = pairs.join(side.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs


_ODD = 0x5555555555555555


def promising(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose estimated similarity comes near the limit."""
    differ = F.aggregate(
        F.zip_with("signature_a", "signature_b", lambda x, y: F.bit_count(
            x.bitwiseXOR(y).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(F.lit(_ODD)))),
        F.lit(0), lambda total, n: total + n)
    estimate = (1 - differ / F.lit(float(_HASHES)) - 0.25) / 0.75
    return _with_both(pairs, sets, ["signature"]).filter(estimate >= LIMIT / 100 - SLACK).select("a", "b")


def full_sets(docs: DataFrame, sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The shingles of the classes in ``ids``: id, shingles; written. Only their texts are read again."""
    wanted = workspace.materialise(sets.join(ids, "id").select("id", "text_key"), "near_wanted")
    keys = wanted.select("text_key").distinct()
    text = text_of(docs)
    texts = (docs.select(F.xxhash64(text).alias("text_key"), text)
             .join(broadcast_if_small(keys), "text_key", "left_semi"))
    found = texts.mapInArrow(_sets, "text_key long, shingles array<long>").dropDuplicates(["text_key"])
    return workspace.materialise(wanted.join(found, "text_key").select("id", "shingles"), "near_sets")


def confirmed(docs: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked, by their full sets; written. ``pairs`` is a written table."""
    full = full_sets(docs, sets, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - shared
    return workspace.materialise(
        _with_both(pairs, full, ["shingles"]).filter(100 * shared >= LIMIT * union).select("a", "b"), "near_links")


def components(links: DataFrame) -> DataFrame:
    """The smallest number that can be reached from each linked one: id, component; written.

    First every number goes to its smallest neighbour, which then is linked to its other
    smaller ones. Numbers that no other has for a smaller neighbour are then done with. Among
    the rest, in each round a label becomes the smallest among neighbours and then that
    one's own, so a chain shortens to half and the rounds grow as its logarithm.
    """
    edges = workspace.materialise(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near_edges")
    least = workspace.materialise(edges.groupBy("a").agg(F.min("b").alias("least")), "near_least")
    among = edges.join(least, "a").filter("b != least").select("b", F.col("least").alias("a")).distinct()
    smaller = edges.select(F.col("b").alias("a")).distinct()
    onward = least.join(smaller, "a", "left_semi").select(F.col("a").alias("b"), F.col("least").alias("a"))
    among = workspace.materialise(among.union(onward), "near_edges")
    leaves = least.select(F.col("a").alias("id"), "least")
    roots = edges.select(F.col("b").alias("a")).distinct().join(least, "a", "left_anti")
    ids = leaves.unionByName(roots.select(F.col("a").alias("id"), F.col("a").alias("least")))
    if among.isEmpty():
        return workspace.materialise(ids.withColumnRenamed("least", "component"), "near_labels")
    known = _labels(among).withColumnRenamed("id", "least")
    return workspace.materialise(
        ids.join(known, "least", "left").select("id", F.coalesce("component", "least").alias("component")), "near_labels")


def _labels(links: DataFrame) -> DataFrame:
    """The smallest number reached from each, by rounds over all links, a written table."""
    edges = links.select("a", "b").union(links.select("b", "a"))
    labels = workspace.materialise(
        edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "near_labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        better = labels.join(near, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("reached"))
        jump = labels.select(F.col("id").alias("reached"), F.col("component").alias("further"))
        moved = workspace.materialise(
            better.join(jump, "reached", "left")
            .select("id", "before", F.least("reached", F.coalesce("further", "reached")).alias("component")), "near_labels")
        labels = moved.select("id", "component")
        if moved.filter("component < before").isEmpty():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _dealt(rows: DataFrame, key: str, more: DataFrame) -> DataFrame:
    """Deals the rows of every group of ``key`` that holds several components to tasks in
    which all pairs of different components meet, outside the largest one at least on one side.

    Rows outside and rows of the largest component are cut into blocks of about :data:`BLOCK`
    rows by hash. A task holds a block outside and any other block, or the same. Adds ``one``
    and ``two``, the task's blocks, ``first``, whether the row is of the former, and the
    columns that ``more`` has for the row's id.
    """
    parts = rows.groupBy(key, "component").agg(F.count("*").alias("size"))
    mixed = (parts.groupBy(key).agg(F.count("*").alias("parts"), F.sum("size").alias("members"),
                                    F.max("size").alias("most"), F.max_by("component", "size").alias("largest"))
             .filter("parts > 1")
             .select(key, "largest", F.ceil((F.col("members") - F.col("most")) / BLOCK).cast("int").alias("outer"),
                     F.ceil(F.col("most") / BLOCK).cast("int").alias("inner")))
    mixed = workspace.materialise(mixed, "near_mixed")
    every = rows.join(mixed, key).join(more, "id").withColumn("outside", F.col("component") != F.col("largest"))
    every = every.withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))).cast("int"))
    outer = F.sequence(F.lit(0), F.col("outer") - 1)
    task = lambda one, two: F.struct(one.alias("one"), two.alias("two"))
    tasks = F.when(F.col("outside"), F.concat(
        F.transform(outer, lambda other: task(F.least("block", other), F.greatest("block", other))),
        F.transform(F.sequence(F.lit(0), F.col("inner") - 1), lambda other: task(F.col("block"), F.col("outer") + other))),
    ).otherwise(F.transform(outer, lambda other: task(other, F.col("outer") + F.col("block"))))
    dealt = every.withColumn("task", F.explode(tasks)).select(
        *rows.columns, *[c for c in more.columns if c != "id"], "outside", "block", "task.*")
    return (dealt.withColumn("first", F.col("outside") & (F.col("block") == F.col("one"))).drop("outside", "block")
            .repartition(key, "one", "two").sortWithinPartitions(key, "one", "two"))


def _tasks(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of one task after another, from sorted batches."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        whole = pa.Table.from_batches([*kept, batch]).combine_chunks()
        names = np.stack([whole[c].to_numpy() for c in (key, "one", "two")])
        borders = np.r_[0, np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1, len(whole)]
        rows = whole.to_batches()[0] if len(whole) else batch
        for low, high in zip(borders[:-2], borders[1:-1], strict=True):
            yield rows.slice(low, high - low)
        kept = [rows.slice(borders[-2], borders[-1] - borders[-2])] if len(whole) else []
    yield from kept


def _joining(ids: np.ndarray, labels: np.ndarray, one: np.ndarray, two: np.ndarray, near) -> list[tuple[int, int]]:
    """Pairs that join rows of different labels, no more than needed. ``near(row)`` tells
    which of the rows ``two`` go with a row of ``one``."""
    labels = np.unique(labels, return_inverse=True)[1]
    found = []
    for row in one:
        hits = two[near(row)]
        hits = hits[labels[hits] != labels[row]]
        if len(hits):
            roots, first = np.unique(labels[hits], return_index=True)
            found += [(int(ids[row]), int(ids[hits[i]])) for i in first]
            labels[np.isin(labels, roots)] = labels[row]
    return found


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                                      names=["a", "b"])


def _sides(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    first = np.asarray(rows["first"].to_numpy(zero_copy_only=False), bool)
    inside = rows["one"][0].as_py() == rows["two"][0].as_py()
    return np.flatnonzero(first), np.arange(len(first)) if inside else np.flatnonzero(~first)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, the members that come near one of another component, each with the
    smallest id that it is connected to through such."""
    least = (LIMIT / 100 - SLACK) * 0.75 + 0.25
    for rows in _tasks(batches, "bucket"):
        one, two = _sides(rows)
        if not len(one) or not len(two):
            continue
        ids, component, size = (rows[c].to_numpy() for c in ("id", "component", "n_shingles"))
        signature = np.asarray(rows["signature"].flatten()).view(np.uint64).reshape(len(ids), -1)

        def near(row: int) -> np.ndarray:
            differ = signature[two] ^ signature[row]
            differ = np.bitwise_count((differ | (differ >> np.uint64(1))) & np.uint64(_ODD)).sum(axis=1, dtype=np.int64)
            fits = 100 * np.minimum(size[two], size[row]) >= LIMIT * np.maximum(size[two], size[row])
            return fits & (component[two] != component[row]) & (1 - differ / _HASHES >= least)

        if found := _connected(ids, one, two, near):
            yield _edges(found)


def _connected(ids: np.ndarray, one: np.ndarray, two: np.ndarray, near) -> list[tuple[int, int]]:
    """The rows that are near another, each with the smallest id it is connected to."""
    labels, touched = np.arange(len(ids)), np.zeros(len(ids), bool)
    for row in one:
        hits = two[near(row)]
        if len(hits):
            touched[row] = touched[hits] = True
            if (labels[hits] != labels[row]).any():
                labels[np.isin(labels, labels[hits])] = labels[row]
    root = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(root, labels, ids)
    root = root[labels]
    return [(int(ids[i]), int(root[i])) for i in np.flatnonzero(touched & (root != ids))]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, links that join different components, by full sets."""
    for rows in _tasks(batches, "cluster"):
        one, two = _sides(rows)
        if not len(one) or not len(two):
            continue
        ids, component = rows["id"].to_numpy(), rows["component"].to_numpy()
        sizes = np.asarray(rows["shingles"].value_lengths()).astype(np.int64)
        values = np.asarray(rows["shingles"].flatten())
        starts = np.r_[0, np.cumsum(sizes)]
        place = np.full(len(ids), -1)
        place[two] = np.arange(len(two))
        owner = np.repeat(place, sizes)
        order = np.argsort(values[owner >= 0], kind="stable")
        listed, owner = values[owner >= 0][order], owner[owner >= 0][order]

        def near(row: int) -> np.ndarray:
            own = values[starts[row]:starts[row + 1]]
            low, high = np.searchsorted(listed, own, "left"), np.searchsorted(listed, own, "right")
            times = high - low
            hits = np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            shared = np.bincount(owner[hits], minlength=len(two))
            return 100 * shared >= LIMIT * (sizes[two] + sizes[row] - shared)

        if found := _joining(ids, component, one, two, near):
            yield _edges(found)


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes that are linked, enough of them to make every component; written."""
    members = _members(sets)
    pivots = sets.select(F.col("id").alias("pivot"), F.col("n_shingles").alias("size"))
    starred = (members.filter("id != pivot").select("id", "pivot", "n_shingles").distinct()
               .join(pivots, "pivot").filter(_sizes_fit("n_shingles", "size")).select(*_pair("id", "pivot")).distinct())
    tried = workspace.materialise(promising(starred, sets), "near_pairs")
    first = confirmed(docs, tried, sets)
    labels = components(first)

    signed = sets.select("id", "signature")
    near = _dealt(_labelled(members.select("bucket", "id", "n_shingles"), labels), "bucket", signed)
    candidates = workspace.materialise(
        near.select("bucket", "one", "two", "first", "id", "component", "n_shingles", "signature")
        .mapInArrow(_candidates, "a long, b long").distinct(), "near_candidates")
    clusters = components(candidates).withColumnRenamed("component", "cluster")
    full = full_sets(docs, sets, clusters.select("id"))
    dealt = _dealt(_labelled(clusters, labels), "cluster", full)
    second = workspace.materialise(
        dealt.select("cluster", "one", "two", "first", "id", "component", "shingles")
        .mapInArrow(_linked, "a long, b long"), "near_links")
    return first.union(second)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: row identity, doc_id, n_shingles, component_id (the smallest
    doc_id of the component) and ``stays``, true for one row of each component."""
    rows = features(docs)
    sets = classes(rows)
    labels = components(links(docs, sets))
    component = sets.join(labels, "id", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("component"))
    known = ["doc_id", "n_shingles", *ROW]
    linked = workspace.materialise(
        rows.select(*known, "set_a", "set_b").join(component, ["set_a", "set_b", "n_shingles"])
        .select(*known, "component"), "near_rows")
    first = workspace.materialise(linked.groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", *ROW)).alias("first")), "near_first")
    found = linked.join(first, "component").select(
        *known, "component_id", F.struct(*ROW).eqNullSafe(F.struct(*[F.col(f"first.{c}") for c in ROW])).alias("stays"))
    alone = rows.filter("n_shingles = 0").select(*known, F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    return found.unionByName(alone)

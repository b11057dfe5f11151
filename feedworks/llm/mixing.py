"""Mixing sources to target weights by a low-discrepancy schedule.

A schedule of ``2 ** bits`` slots hands one slot after another to a source. Slot
n lies at the van der Corput point n, its bits reversed; the targets, laid end to
end, cut the range of points into one interval per source. One point of each interval is
set apart for its source, so that a source has a slot however small its target is. The r-th slot
of a source takes the r-th block of its stream: its documents in shuffled order, repeated from
the start when they run out, up to the target, and cut into as many blocks as the source has
slots, equal to one word. So all of every target is taken, and every run of slots
holds the words of each source in proportion to its target.

Which slots are a source's, and the rank of each, follow from the slot's number
alone, so no source passes through one task. Places in a stream are summed in
buckets of the shuffle order first, then within them.

Defined results: null text has no words; null is a source of its own, after the
others; a document without words is never taken; identical rows share the order
in the stream in either way; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import ROW, WORD, broadcast_if_small, numbered, text_of

#: Weights of the sources in order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its own size.
MOST_REPEATS = 3
#: Most words of a block.
BLOCK_WORDS = 128
#: Rows aimed at in a bucket of the shuffle order, and the most buckets of a source.
_BUCKET_ROWS, _MOST_BUCKETS = 64, 1 << 16
#: Points turned into slots by one row of work, and such rows in a task.
_POINTS, _ROWS_OF_POINTS = 1 << 16, 8


def document_sizes(docs: DataFrame) -> DataFrame:
    """Row identity, doc_id, source, size in words and shuffle key, written once."""
    text = text_of(docs)
    key = F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.md5(text)))
    return workspace.materialise(numbered(
        docs, docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key")), "mix_sizes")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: its target and its interval of points, written once.

    The targets share the size of all sources by weight; none is above
    ``most_repeats`` times its source's size, and what that leaves over goes to
    the others by weight. Windows here see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_level = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    earlier = (Window.unboundedPreceding, -1)
    place = F.col("number") % len(weights) + 1
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ranked = (totals.withColumn("number", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place.cast("int")).cast("long"))
              .withColumn("cap", most_repeats * F.col("source_size"))
              .withColumn("total", F.sum("source_size").over(everything)))
    # Fill all sources to one level; those whose cap is lower stay at it. The level
    # is the largest that any set of the lowest caps leaves to the others.
    left = F.col("total") - F.coalesce(F.sum("cap").over(by_level.rowsBetween(*earlier)), F.lit(0))
    others = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("left_over", left.cast("double") / others)
    level = F.max("left_over").over(everything)
    quotas = (levels.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight")))
              .withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
              .withColumn("all_quotas", F.sum("quota").over(everything))
              .withColumn("through", F.sum("quota").over(by_name.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("own", (F.col("quota") > 0).cast("long"))
              .withColumn("all_own", F.sum("own").over(everything))
              .withColumn("own_through", F.sum("own").over(by_name.rowsBetween(Window.unboundedPreceding, 0))))
    # A point for each source with a target, the others shared by target.
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest("all_quotas", F.lit(1)) / block_words + F.col("all_own")))).cast("int")
    shared = lambda upto: F.floor(upto.cast("double") / F.greatest("all_quotas", F.lit(1)) * (F.col("slots") - F.col("all_own"))).cast("long")
    columns = ["number", "source", "source_size", "target", "quota", "bits", "buckets", "first_point", "end_point"]
    return workspace.materialise(
        quotas.withColumn("bits", bits)
        .withColumn("slots", F.expr("shiftleft(1L, bits)"))
        .withColumn("first_point", F.col("own_through") - F.col("own") + shared(F.col("through") - F.col("quota")))
        .withColumn("end_point", F.when(F.col("own") > 0, F.col("own_through") + shared(F.col("through"))).otherwise(F.col("first_point")))
        .withColumn("buckets", F.least(F.lit(_MOST_BUCKETS), F.ceil(F.col("rows") / _BUCKET_ROWS)).cast("int"))
        .select(*columns), "mix_sources")


def source_slots(sources: DataFrame) -> DataFrame:
    """All slots: the source's number, the slot, and its rank among that source's slots."""
    parts = sources.filter("end_point > first_point").withColumn(
        "part", F.explode(F.sequence("first_point", F.col("end_point") - 1, F.lit(_POINTS))))
    # The rows are few and short but not what comes of them, so their bytes don't tell how many tasks they need.
    count = sources.agg(F.sum(F.ceil((F.col("end_point") - F.col("first_point")) / _POINTS))).first()[0] or 0
    wide = parts.select("number", "first_point", "end_point", "bits", "part").repartition(
        max(1, -(-count // _ROWS_OF_POINTS)), "number", "part")
    return wide.mapInPandas(_slots_of_points, "number int, slot long, block_number long")


def _slots_of_points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in batch.itertuples():
            points = np.arange(part.part, min(part.part + _POINTS, part.end_point), dtype=np.int64)
            slots = reverse_bits(points, part.bits)
            ranks = points_below(slots, part.end_point, part.bits) - points_below(slots, part.first_point, part.bits)
            yield pd.DataFrame({"number": np.int32(part.number), "slot": slots, "block_number": ranks})


def reverse_bits(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(values)
    for k in range(bits):
        out |= ((values >> k) & 1) << (bits - 1 - k)
    return out


def points_below(slots: np.ndarray, bound: int, bits: int) -> np.ndarray:
    """How many of the slots before each have a point below ``bound``.

    The slots before n fall into aligned runs, one per bit that n has set. The
    points of a run of ``2 ** k`` slots are a grid with steps of ``2 ** (bits - k)``.
    """
    count = np.zeros_like(slots)
    for k in range(bits):
        run_start = (slots >> (k + 1)) << (k + 1)
        step = bits - k
        on_grid = (bound - reverse_bits(run_start, bits) + (1 << step) - 1) >> step
        count += np.where((slots >> k) & 1, np.clip(on_grid, 0, 1 << k), 0)
    return count


def stream_places(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of ``sizes`` with their source's columns and ``start``, the words
    that come before them in the source's stream."""
    by_source = (sizes.withColumnRenamed("source", "its_source")
                 .join(broadcast_if_small(sources), F.col("its_source").eqNullSafe(F.col("source")))
                 .drop("its_source"))
    prefix = F.conv(F.substring("key", 1, 4), 16, 10).cast("long")
    rows = by_source.withColumn("bucket", F.floor(prefix * F.col("buckets") / _MOST_BUCKETS).cast("int"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
               .select("number", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before")))
    within = (Window.partitionBy("number", "bucket").orderBy("key", "size", *ROW)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(buckets, ["number", "bucket"])
            .withColumn("start", F.col("words_before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .drop("words_before"))


def schedule(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """The mix in full: which words of which document each slot takes.

    Columns: row identity, doc_id, number of the source, slot, from_word and words.
    """
    rounds = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - F.col("start") - 1) / F.col("source_size")))
    placed = (stream_places(sizes, sources).filter("size > 0 and start < quota")
              .withColumn("round", F.explode(rounds))
              .withColumn("low", F.col("round") * F.col("source_size") + F.col("start"))
              .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("quota"))))
    # Block r begins at the word floor(r * quota / slots).
    starts = lambda block: f"cast({block} as decimal(19)) * cast(quota as decimal(19)) div cast(n_slots as decimal(19))"
    holds = lambda word: f"(cast({word} + 1 as decimal(19)) * cast(n_slots as decimal(19)) - 1) div cast(quota as decimal(19))"
    pieces = (placed.withColumn("n_slots", F.col("end_point") - F.col("first_point"))
              .withColumn("block_number", F.explode(F.sequence(F.expr(holds("low")), F.expr(holds("(high - 1)")))))
              .withColumn("cut", F.greatest(F.col("low"), F.expr(starts("block_number"))))
              .withColumn("words", F.least(F.col("high"), F.expr(starts("(block_number + 1)"))) - F.col("cut"))
              .filter("words > 0")
              .select(*ROW, "doc_id", "number", "block_number", (F.col("cut") - F.col("low")).alias("from_word"), "words"))
    # Few sources make many slots, which Spark's estimate doesn't see: never broadcast them.
    return pieces.join(source_slots(sources).hint("merge"), ["number", "block_number"]).drop("block_number")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: row identity, doc_id, source, size, source_size, target of the
    source, and ``taken``, the words that the schedule takes, repeats counted."""
    sizes = document_sizes(docs)
    sources = source_targets(sizes, weights, most_repeats, block_words)
    taken = schedule(sizes, sources).groupBy(*ROW).agg(F.sum("words").alias("taken"))
    known = sources.select(F.col("source").alias("its_source"), "source_size", "target")
    return (sizes.join(taken, ROW, "left")
            .join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("its_source")))
            .select(*ROW, "doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))

"""Folding ordered rows into one row per segment.

Rows are read in order. A closing row ends the segment of the rows before it
and gives the segment its key; the kept rows among them are joined to one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.functions import has_marker, is_subject_line
from feedworks.operators.ordered import (
    BLOCK, FILE, POSITION, with_file_position, with_range_blocks,
)
from feedworks.schema import ACCESSION_TAG, SUBJECT_COLUMNS, SUBJECT_SEPARATOR


def fold(df: DataFrame, *, order: list[str], is_end: Column, keep: Column,
         key: Column, value: Column, partition_by: list[str] = (),
         block: list[str] | Column | None = None, n_blocks: int | None = None,
         sep: str = SUBJECT_SEPARATOR,
         names: tuple[str, str] = SUBJECT_COLUMNS) -> DataFrame:
    """One row per closing row: ``partition_by`` columns, key and joined values.

    ``order`` must be unique within ``partition_by``. Kept rows after the last
    closing row belong to no segment and are dropped; a closing row with nothing
    before it gives an empty text. A closing row is never kept itself.

    The rows are folded in blocks and the ends of the blocks are then stitched
    together, so that no partition has to fit into a task. ``block`` names the
    blocks: columns, or an expression that never decreases along ``order`` and
    takes each value for a bounded number of rows, like ``turn div 1000``. Where
    it is missing, ``n_blocks`` ranges of the order columns are used (by default as many as
    Spark's shuffle partitions), at the price of one more shuffle. Only the text of one segment is ever held as a whole.
    """
    partition_by = list(partition_by)
    ends, kept = F.coalesce(is_end, F.lit(False)), F.coalesce(keep, F.lit(False))
    if isinstance(block, Column):
        df, block = df.withColumn(BLOCK, block), [BLOCK]
    columns = list(dict.fromkeys([*partition_by, *(block or []), *order]))
    rows = (df.select(*columns, ends.alias("_end"), (kept & ~ends).alias("_keep"),
                      key.alias("_key"), value.alias("_value"))
            .where("_end OR _keep"))
    if block is None:
        rows, block = with_range_blocks(rows, *partition_by, *order, n_blocks=n_blocks), [BLOCK]

    # 1. Within a block. The aggregation reuses the window's shuffle.
    place = [*partition_by, *block]
    rows = rows.withColumn("_segment", _ends_before(place, order))
    parts = rows.groupBy(*place, "_segment").agg(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("_keep"), F.struct(*order, "_value")))),
            lambda r: r["_value"]).alias("_values"),
        F.max("_end").alias("_end"),
        F.max(F.when(F.col("_end"), F.col("_key"))).alias("_key"))
    parts = workspace.materialise(
        parts.withColumn("_part", F.monotonically_increasing_id()), "segments")

    # 2. Closed by a row of its own block and begun after another: final.
    final = F.col("_end") & (F.col("_segment") > 0)
    done = parts.where(final).select(*partition_by, "_key", "_values")

    # 3. The first and the last piece of a block may go on in a neighbour. Which
    # ones belong together is found without their texts, at most two short rows
    # per block; only texts of segments that do get closed are moved, and those of
    # a single piece, as of all partitions within one block, are then complete.
    loose = parts.where(~final)
    closed = loose.join(_chains(loose, partition_by, block), "_part")
    whole = closed.where("_pieces = 1").select(*partition_by, "_key", "_values")
    stitched = (closed.where("_pieces > 1").groupBy(*partition_by, "_whole").agg(
        F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct(*block, "_segment", "_values"))),
            lambda r: r["_values"])).alias("_values"),
        F.max("_key").alias("_key"))
        .select(*partition_by, "_key", "_values"))

    return done.unionByName(whole).unionByName(stitched).select(
        *partition_by, F.col("_key").alias(names[0]),
        F.array_join("_values", sep).alias(names[1]))


def _chains(loose: DataFrame, partition_by: list[str], block: list[str]) -> DataFrame:
    """The loose pieces that a closing row ends: ``_part``, ``_whole``, the number of closing
    rows before them in their partition, and ``_pieces``, how many share that number.

    Blocks of several columns, like file and split, are counted within each outer block and then
    over the outer blocks, one row each, so no task sees the rows of all.
    """
    short = loose.select("_part", *partition_by, *block, "_segment", F.col("_end").cast("long").alias("_end"))
    outer = [*partition_by, *block[:-1]]
    within = Window.partitionBy(*outer)
    before = within.orderBy(block[-1], "_segment").rowsBetween(Window.unboundedPreceding, -1)
    counted = short.withColumn("_whole", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    if block[:-1]:
        totals = counted.groupBy(*outer).agg(F.sum("_end").alias("_ends"))
        among = Window.partitionBy(*partition_by)
        earlier = F.sum("_ends").over(among.orderBy(*block[:-1]).rowsBetween(Window.unboundedPreceding, -1))
        offsets = totals.select(*[F.col(c).alias(f"_{c}") for c in outer], F.coalesce(earlier, F.lit(0)).alias("_earlier"),
                                F.sum("_ends").over(among).alias("_closing"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in outer]
        counted = counted.join(offsets, same).withColumn("_whole", F.col("_whole") + F.col("_earlier"))
    else:
        counted = counted.withColumn("_closing", F.sum("_end").over(within))
    pieces = F.count("*").over(Window.partitionBy(*partition_by, "_whole"))
    return (counted.where(F.col("_whole") < F.col("_closing"))
            .select("_part", "_whole", pieces.alias("_pieces")))


def _ends_before(partition_by: list[str], order: list[str]) -> Column:
    """Number of closing rows before the current one."""
    before = (Window.partitionBy(*partition_by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.sum(F.col("_end").cast("long")).over(before), F.lit(0).cast("long"))


def catalogue_subjects(export: DataFrame, across_files: bool = False) -> DataFrame:
    """Accession numbers with their subject lines from a catalogue export.

    ``export`` comes straight from :func:`feedworks.sources.delimited`; its first
    column is the tag, its second the text. ``across_files`` reads the files in
    the order of their names as one export; otherwise each file stands alone.
    """
    tag, text = (F.col(f"`{c}`").cast("string") for c in export.columns[:2])
    partition_by, block = ([], [FILE, BLOCK]) if across_files else ([FILE], [BLOCK])
    subjects = fold(
        with_file_position(export), order=[POSITION], partition_by=partition_by, block=block,
        is_end=has_marker(tag, ACCESSION_TAG), keep=is_subject_line(text), key=text, value=text)
    return subjects.select(*SUBJECT_COLUMNS)

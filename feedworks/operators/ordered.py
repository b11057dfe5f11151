"""Work that depends on the order of rows, done in blocks.

A block is a run of neighbouring rows small enough for one task: an input split
of a file, or a range of order values. State is carried from block to block
through one small row per block, so no file, key or segment has to pass through
a single task as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, BLOCK, POSITION = "_file", "_block", "_position"


def with_file_position(df: DataFrame, *more: Column) -> DataFrame:
    """Add file, split offset and row position to a frame straight from a file
    reader. Positions rise within a split; read them in one job only
    (see :func:`feedworks.workspace.materialise`)."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POSITION),
        *more,
    )


def with_range_blocks(df: DataFrame, *columns: str | Column, n_blocks: int | None = None) -> DataFrame:
    """Cut ``df`` into blocks by ranges of ``columns``; a heavy leading value is
    spread over several blocks. There are ``n_blocks`` at most, by default
    ``spark.sql.shuffle.partitions``; a block is sorted in one task, so large inputs
    need more. ``df`` is read once more for a sample of its values. Use the
    result in one job only."""
    by = (n_blocks, *columns) if n_blocks else columns
    return df.repartitionByRange(*by).withColumn(BLOCK, F.spark_partition_id())


def carry_forward(df: DataFrame, value: str, order: list[str], block: list[str],
                  partition_by: list[str] = ()) -> DataFrame:
    """Fill nulls of ``value`` with the last non-null one before them.

    ``df`` must be a written table. One shuffle by block for the rows; between
    blocks only the last value of each block travels.
    """
    place = [*partition_by, *block]
    upto_here = (Window.partitionBy(*place).orderBy(*order)
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = df.withColumn("_seen", F.last(value, ignorenulls=True).over(upto_here))

    position = F.struct(*order)
    last = df.groupBy(*place).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), position)).alias("_last"))
    incoming = _before(last, partition_by, block)
    return (rows.join(incoming, place, "left")
            .withColumn(value, F.coalesce("_seen", "_incoming"))
            .drop("_seen", "_incoming"))


def _before(last: DataFrame, partition_by: list[str], block: list[str]) -> DataFrame:
    """The last value of the blocks before each, as ``_incoming``.

    Blocks of several columns, like file and split, are gone through level by level: one
    row per block within each outer block, then one row per outer block.
    """
    *outer, inner = block
    level = [*partition_by, *outer]
    before = Window.partitionBy(*level).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    within = last.select(*level, inner, F.last("_last", ignorenulls=True).over(before).alias("_incoming"))
    if not outer:
        return within
    ends = last.groupBy(*level).agg(F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col(inner))).alias("_last"))
    earlier = _before(ends, partition_by, outer).withColumnRenamed("_incoming", "_earlier")
    return within.join(earlier, level).select(
        *level, inner, F.coalesce("_incoming", "_earlier").alias("_incoming"))

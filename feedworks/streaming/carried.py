"""Streams whose batches go on where the one before ended.

What a batch leaves open, like the last network of a document or the rows of a segment
that nothing has closed yet, is state by key. It is written below a folder of its own, a
partition per batch: batch n reads what batch n - 1 left and writes all that is open
after it. A batch that runs again after a failure thus begins where it began before,
and replaces what it wrote. State that is older than that is deleted.

Batches are ordinary ones: their work is done in blocks as it is without a stream, so that neither a
document nor a key has to pass through a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks import workspace
from feedworks.operators.ordered import BLOCK, FILE, POSITION, carry_forward
from feedworks.operators.segments import fold
from feedworks.schema import EVENT, NETWORK, SUBJECT_COLUMNS, SUBJECT_SEPARATOR
from feedworks.sinks.files import write_batch
from feedworks.sources.xml import event_tokens, events_of_tokens
from feedworks.streaming.run import Sink


def _left_open(spark, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the batch before left open."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id - 1}")


def _leave_open(state: DataFrame, path: str, batch_id: int) -> None:
    write_batch(state, path, batch_id)
    # The batch before may run again no more; the state it began with has served.
    workspace.delete(state.sparkSession, f"{path}/batch_id={batch_id - 2}")


def event_rows_sink(sink: Sink, state: str, event: T.StructType = EVENT, document: Column | None = None) -> Sink:
    """For :func:`feedworks.sources.xml_event_stream`: hands ``sink`` the rows that
    :func:`feedworks.sources.xml_event_rows` has for the files of a batch.

    A document goes on from file to file, in the order of their names within a batch and of batches
    among each other: events at the start of a file belong to the network that an earlier one
    left open. All files are one document, or those for which ``document``, an expression over
    the column ``_file`` with the file's path, is the same. ``state`` is a folder for the last network of
    each document.
    """
    key, position = "_document", [FILE, BLOCK, POSITION, "_place"]
    name = F.lit("") if document is None else document
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("_open", NETWORK)])

    def write(batch: DataFrame, batch_id: int) -> None:
        with workspace.scratch(batch.sparkSession):
            table = event_tokens(batch, event).withColumn(key, name.cast("string"))
            # What is open stands before all files, as a token of its own.
            opened = _left_open(batch.sparkSession, state, batch_id, schema).select(
                key, F.lit("").alias(FILE), F.lit(-1).cast("long").alias(BLOCK), F.lit(-1).cast("long").alias(POSITION),
                F.lit(0).alias("_place"), F.col("_open").alias("_net"))
            every = table.unionByName(opened, allowMissingColumns=True)
            after = every.groupBy(key).agg(
                F.max_by("_net", F.when(F.col("_net").isNotNull(), F.struct(*position))).alias("_open"))
            filled = carry_forward(every, "_net", [POSITION, "_place"], [FILE, BLOCK], [key])
            sink(events_of_tokens(table, filled, event), batch_id)
            _leave_open(after, state, batch_id)
    return write


def fold_sink(sink: Sink, state: str, *, order: list[str], is_end: Column, keep: Column, key: Column, value: Column,
              partition_by: list[str] = (), block: Column | None = None, n_blocks: int | None = None,
              sep: str = SUBJECT_SEPARATOR, names: tuple[str, str] = SUBJECT_COLUMNS) -> Sink:
    """Hands ``sink`` the segments that a batch closes, as :func:`feedworks.operators.segments.fold`
    has them; a segment may have begun any number of batches before.

    Within ``partition_by`` the ``order`` rises from batch to batch, too. ``state`` is a folder for the
    kept rows that no closing row has followed yet. All of them are written with each batch, so
    segments that stay open long should be few.
    """
    partition_by = list(partition_by)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends, kept = F.coalesce(is_end, F.lit(False)), F.coalesce(keep, F.lit(False))
        own = batch.select(*partition_by, *order, ends.alias("_end"), (kept & ~ends).alias("_keep"),
                           key.alias("_key"), value.alias("_value")).where("_end OR _keep")
        with workspace.scratch(spark):
            rows = workspace.materialise(_left_open(spark, state, batch_id, own.schema).unionByName(own), "open-rows")
            closed = fold(rows, order=order, is_end=F.col("_end"), keep=F.col("_keep"), key=F.col("_key"), value=F.col("_value"),
                          partition_by=partition_by, block=block, n_blocks=n_blocks, sep=sep, names=names)
            sink(closed, batch_id)
            _leave_open(_behind_the_last_end(rows, partition_by, order), state, batch_id)
    return write


def _behind_the_last_end(rows: DataFrame, partition_by: list[str], order: list[str]) -> DataFrame:
    """The rows of each partition that no closing row follows."""
    ends = rows.where("_end")
    if not partition_by:
        last = ends.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
        if last is None:
            return rows
        return rows.where(F.struct(*order) > F.struct(*[F.lit(last[c]).cast(rows.schema[c].dataType).alias(c) for c in order]))
    last = ends.groupBy(*[F.col(c).alias(f"_of_{c}") for c in partition_by]).agg(F.max(F.struct(*order)).alias("_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in partition_by]
    still = rows.join(last, same, "left").where(F.col("_last").isNull() | (F.struct(*order) > F.col("_last")))
    return still.select(*rows.columns)

"""A keyed upsert table in the catalogue.

Two tables make one. Batches are appended to ``<table>_log``, a partition per batch, without
any shuffle. ``<table>`` itself holds a row per key as far as batches have been folded
into it, cut into partitions by a hash of the key. The current state is an aggregation by key
over it and the batches after it; rows are combined before the shuffle, so a key with very
many changes costs no more than any other.

Key, mode, number of buckets and the last batch folded in are properties of the table; its columns
are the catalogue's. A compaction folds the batches in. It writes the buckets that they
touch beside the table, names that copy in a property, which is when it counts, and then moves
it in by a dynamic INSERT OVERWRITE. A job that dies on the way leaves either the old
state or the copy, which readers take in place of those buckets and the next writer moves in.

One writer per table: feeds that share a table are united before the upsert.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.operators.nested import flatten_structs
from feedworks.sinks.files import check_batch
from feedworks.sinks.tables import (
    create_table, fitted, newest_table_batch, overwrite_partitions, properties, replace_batch, set_properties, table_location,
)
from feedworks.workspace import delete, partition_values

ORDER, _BUCKET = "_order", "_bucket"
MODES = ("merge", "replace")
#: Partitions of a new table. They bound how little a compaction may rewrite, not how many
#: tasks write: a large bucket is written by several.
BUCKETS = 64

_KEY, _MODE, _UPTO, _PENDING, _COUNT, _RANK = (
    "feedworks." + name for name in ("key", "mode", "upto", "pending", "buckets", "rank"))


def keyed_upsert(df: DataFrame, table: str, key: str | list[str], order_by: list[str] = (),
                 batch_id: int | None = None, mode: str | None = None, path: str | None = None,
                 buckets: int = BUCKETS, replay_safe: bool = False) -> int:
    """Append ``df`` as a batch of inserts and updates; returns the batch id.

    Later batches win. Within a batch the row with the highest ``order_by`` wins;
    what is still equal is decided by the row's content, so that every reader
    sees the same state. Structs are flattened, so that they merge field by
    field. Columns that are new to the table are added to it, and narrower numbers widened to the
    table's. A row without a key cannot be addressed and fails the batch; see
    :func:`with_key` to part such rows. Writing the last ``batch_id`` again replaces that batch.

    In ``mode`` ``merge`` a null in a newer row keeps the older value; ``replace`` takes
    the newest row as it is. The first call that names a mode when it writes, a batch or at the latest
    the first compaction (``merge`` by default), settles it for the table.

    With ``replay_safe`` ``order_by``, like the place of a message in its log, decides between rows of
    different batches too. What has been read before may then come again in any
    batches, also under numbers of another checkpoint, and changes nothing. Such a table takes
    newest rows whole (``replace``), keeps their order beside them, and numbers its batches itself.

    The first batch creates the table, with so many ``buckets``, below ``path`` if given.
    """
    spark, log = df.sparkSession, _log(table)
    flat = flatten_structs(df)
    keys = [key] if isinstance(key, str) else list(key)
    if mode is not None and mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    # Of the batch's own columns: a row has the same tie whatever columns the table has by then.
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in flat.columns]).alias("_tie")
    order = F.struct(*order_by, tie)
    if replay_safe:
        if not order_by or mode == "merge":
            raise ValueError("a replay-safe table needs an order, and takes newest rows whole")
        mode, batch_id = "replace", None
    if not spark.catalog.tableExists(table):
        if path and partition_values(spark, f"{path}/log", "batch_id"):
            raise ValueError(f"{path} has batches of a table that the catalogue doesn't know")
        kept = flat.withColumn(ORDER, order).schema if replay_safe else flat.schema
        create_table(spark, table, [*kept, T.StructField(_BUCKET, T.IntegerType())], [_BUCKET], path and f"{path}/state",
                     {_KEY: json.dumps(keys), _COUNT: str(buckets), _RANK: "order" if replay_safe else "batch"})
    held = _held(spark, table, keys, mode)
    if held["by_order"] != replay_safe:
        raise ValueError(f"{table} is {'' if held['by_order'] else 'not '}replay-safe")
    rows = fitted(flat, table, but=_BUCKET, grow=True)
    for name in keys:
        missing = F.raise_error(F.lit(f"upsert of a row without {name}"))
        rows = rows.withColumn(name, F.when(F.col(name).isNull(), missing).otherwise(F.col(name)))
    logged = spark.catalog.tableExists(log)
    newest = newest_table_batch(spark, log) if logged else None
    if batch_id is None:
        batch_id = (-1 if newest is None else newest) + 1
    check_batch(batch_id, newest, table)
    if held["upto"] is not None and batch_id <= held["upto"]:
        # Already folded in, and the same rows: batches repeat as they were.
        return batch_id
    rows = rows.withColumn(ORDER, order)
    if logged:
        ordered = spark.table(log).schema[ORDER].dataType
        if ordered.simpleString() != rows.schema[ORDER].dataType.simpleString():
            raise ValueError(f"batches of {table} are ordered by {', '.join(ordered.names[:-1]) or 'nothing'}")
        rows = fitted(rows, log, but="batch_id", grow=True)
    if mode:
        set_properties(spark, table, {_MODE: mode})
    replace_batch(rows, log, batch_id, path and f"{path}/log")
    return batch_id


def with_key(df: DataFrame, key: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` that have a whole key, and the others."""
    missing = None
    for name in [key] if isinstance(key, str) else key:
        missing = F.col(name).isNull() if missing is None else missing | F.col(name).isNull()
    return df.where(~missing), df.where(missing)


def _log(table: str) -> str:
    return f"{table}_log"


def _held(spark: SparkSession, table: str, keys: list[str] | None = None, mode: str | None = None) -> dict:
    """What the table's properties say; refuses another key or mode."""
    found = properties(spark, table) if spark.catalog.tableExists(table) else {}
    if _KEY not in found:
        raise ValueError(f"no upsert table {table}")
    own, settled = json.loads(found[_KEY]), found.get(_MODE)
    if keys is not None and own != keys:
        raise ValueError(f"the key of {table} is {', '.join(own)}")
    if mode is not None and mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if mode is not None and settled not in (None, mode):
        raise ValueError(f"the mode of {table} is {settled}")
    pending = json.loads(found.get(_PENDING) or "null")
    upto = pending["upto"] if pending else int(found[_UPTO]) if found.get(_UPTO) else None
    return {"key": own, "mode": settled or mode, "buckets": int(found[_COUNT]), "pending": pending, "upto": upto,
            "by_order": found.get(_RANK) == "order"}


def _keys(key: str | list[str] | None) -> list[str] | None:
    return [key] if isinstance(key, str) else key and list(key)


def current_state(spark: SparkSession, table: str, key: str | list[str] | None = None,
                  mode: str | None = None, merge_schema: bool = True) -> DataFrame:
    """One row per key, with all columns that any batch had. ``key`` and ``mode`` are the
    table's own; others are refused. ``merge_schema`` is there for older callers only.

    A compaction replaces files: a reader that was at work on its buckets has to begin again."""
    held = _held(spark, table, _keys(key), mode)
    # Another session may have written.
    for name in (table, _log(table)):
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
    return _state(spark, table, held, None).drop(ORDER)


def _changes(spark: SparkSession, table: str, held: dict) -> DataFrame | None:
    """Rows of the batches that haven't been folded in, with their rank."""
    log, upto = _log(table), -1 if held["upto"] is None else held["upto"]
    newest = newest_table_batch(spark, log) if spark.catalog.tableExists(log) else None
    if newest is None or newest <= upto:
        return None
    changes = spark.table(log).where(F.col("batch_id") > upto)
    rank = F.col(ORDER) if held["by_order"] else F.struct("batch_id", f"{ORDER}.*")
    return changes.withColumn("_rank", rank).drop("batch_id", ORDER)


def _folded(spark: SparkSession, table: str, held: dict, buckets: list[int] | None) -> DataFrame:
    """The rows of the table as they count: buckets of a pending copy in place of its own."""
    rows, pending = spark.table(table), held["pending"]
    if pending:
        copy = spark.read.schema(rows.schema).parquet(pending["path"])
        rows = rows.where(~F.col(_BUCKET).isin(pending["buckets"])).unionByName(copy)
    return rows if buckets is None else rows.where(F.col(_BUCKET).isin(buckets))


def _state(spark: SparkSession, table: str, held: dict, buckets: list[int] | None) -> DataFrame:
    keys, folded = held["key"], _folded(spark, table, held, buckets).drop(_BUCKET)
    changes = _changes(spark, table, held)
    if changes is None:
        return folded
    columns = [c for c in folded.columns if c != ORDER]
    if held["by_order"]:
        changes = changes.unionByName(folded.withColumnRenamed(ORDER, "_rank"))
        newest = F.max_by(F.struct(*[c for c in columns if c not in keys], F.col("_rank").alias(ORDER)), "_rank")
        return changes.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*columns, ORDER)
    if held["upto"] is not None:
        # Every batch in the log is newer than what has been folded in.
        oldest = F.struct(*[F.lit(-1 if f.name == "batch_id" else None).cast(f.dataType).alias(f.name)
                            for f in changes.schema["_rank"].dataType.fields])
        changes = changes.unionByName(folded.withColumn("_rank", oldest))
    values = [c for c in columns if c not in keys]
    if not values:
        return changes.select(*keys).distinct()
    if held["mode"] == "replace":
        newest = F.max_by(F.struct(*values), "_rank").alias("_row")
        return changes.groupBy(*keys).agg(newest).select(*keys, "_row.*")
    return changes.groupBy(*keys).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in values])


def _bucket(held: dict):
    return F.pmod(F.xxhash64(*held["key"]), F.lit(held["buckets"])).cast("int")


def compact(spark: SparkSession, table: str, key: str | list[str] | None = None,
            mode: str | None = None) -> int | None:
    """Fold the batches into the table; returns the last one in it.

    Only the buckets that those batches touch are read and written, each by as many tasks as
    its size asks for. They count all at once, when the copy is complete.
    """
    if not spark.catalog.tableExists(table):
        return None
    held = _held(spark, table, _keys(key), mode)
    held = _moved_in(spark, table, held)
    changes = _changes(spark, table, held)
    if changes is None:
        return held["upto"]
    if not held["mode"]:
        held["mode"] = "merge"
    set_properties(spark, table, {_MODE: held["mode"]})
    newest = newest_table_batch(spark, _log(table))
    touched = sorted(row[0] for row in changes.select(_bucket(held)).distinct().collect())
    if not touched:
        set_properties(spark, table, {_UPTO: str(newest)})
        return newest
    copy = f"{table_location(spark, table)}/_pending_{newest}"
    state = _state(spark, table, held, touched).withColumn(_BUCKET, _bucket(held))
    state = state.where(F.col(_BUCKET).isin(touched)) if held["by_order"] else state
    state.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).mode("overwrite").parquet(copy)
    pending = {"upto": newest, "buckets": touched, "path": copy}
    set_properties(spark, table, {_PENDING: json.dumps(pending)})
    _moved_in(spark, table, {**held, "pending": pending})
    return newest


def _moved_in(spark: SparkSession, table: str, held: dict) -> dict:
    """Puts a pending copy into the table's partitions, also when that had begun before."""
    pending = held["pending"]
    if not pending:
        return held
    copy = spark.read.schema(spark.table(table).schema).parquet(pending["path"])
    overwrite_partitions(copy, table)
    set_properties(spark, table, {_UPTO: str(pending["upto"]), _PENDING: ""})
    delete(spark, pending["path"])
    return {**held, "pending": None, "upto": pending["upto"]}


def expire(spark: SparkSession, table: str) -> None:
    """Drop the batches that have been folded into the table. Readers that began before that
    must have ended."""
    held = _moved_in(spark, table, _held(spark, table))
    log = _log(table)
    if held["upto"] is None or not spark.catalog.tableExists(log):
        return
    folder = table_location(spark, log)
    for number in partition_values(spark, folder, "batch_id"):
        if number <= held["upto"]:
            spark.sql(f"ALTER TABLE {log} DROP IF EXISTS PARTITION (batch_id = {number})")
            # Of a table at a path of its own the catalogue drops the entry only.
            delete(spark, f"{folder}/batch_id={number}")

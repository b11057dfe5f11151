"""Small files of outputs with a partition per batch, brought together.

A batch leaves at least a file per task, however few its rows. Packing takes runs of
neighbouring batches, up to a target size each, and writes the rows of a run into the
partition of its last batch, in as many files as its bytes ask for. Rows stay as they are;
the partition's number then tells the last batch that they may come from. The newest batch is
left alone, since it may be written again.

All runs are written in one job, beside the output, and a note names them once they are
complete. Then they take the place of the partitions they were made of. If that is cut short,
the next packing, or the next batch of a sink that packs, takes it up again. Readers at work
on those partitions have to begin again.

A run that is still short of its target is packed with what comes later only when that is no
less than its largest batch. So rows are written again about as often as their output doubles,
not with every call.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks.sinks.files import newest_batch
from feedworks.sinks.tables import (
    drop_batch, newest_table_batch, overwrite_partitions, properties, set_properties, table_location,
    unsorted_partitions,
)
from feedworks.sinks.upsert import ORDER
from feedworks.workspace import delete, folder_size, move, partition_values, read_note, write_note

#: Bytes aimed at in a file.
TARGET_BYTES = 128 << 20

_COPY, _NOTE, _PACKING = "_packed", "packing", "feedworks.packing"

#: Batch, its bytes and its number of files.
Sized = tuple[int, int, int]


def n_files(size: int, target: int) -> int:
    return max(1, -(-size // target))


def runs_to_pack(batches: Iterable[Sized], target: int = TARGET_BYTES) -> list[list[Sized]]:
    """Runs of neighbouring batches that are worth packing, in order.

    A batch of half the target or more, in few files, stays as it is.
    """
    runs, run = [], []

    def close() -> None:
        short = sum(size for _, size, _ in run) < target
        while short and len(run) > 1 and run[0][1] > sum(size for _, size, _ in run[1:]):
            del run[0]
        if len(run) > 1 or (run and _scattered(run[0], target)):
            runs.append(list(run))
        run.clear()

    for batch in batches:
        if 2 * batch[1] >= target and not _scattered(batch, target):
            close()
            continue
        run.append(batch)
        if sum(size for _, size, _ in run) >= target:
            close()
    close()
    return runs


def _scattered(batch: Sized, target: int) -> bool:
    return batch[2] > 2 * n_files(batch[1], target)


def _sized(spark: SparkSession, folder: str, upto: int) -> list[Sized]:
    numbers = [n for n in partition_values(spark, folder, "batch_id") if n <= upto]
    return [(n, *folder_size(spark, f"{folder}/batch_id={n}")) for n in numbers]


def _write_runs(rows: DataFrame, runs: list[list[Sized]], target: int, copy: str, fmt: str, **options) -> None:
    """Writes each run into the partition of its last batch below ``copy``: one shuffle for all, and
    a task per file, which takes every so-many-th row of the run."""
    places, first = [], 0
    for run in runs:
        parts = n_files(sum(size for _, size, _ in run), target)
        places += [(number, run[-1][0], first, parts) for number, _, _ in run]
        first += parts
    # A row of four numbers per batch that the driver has listed.
    placed = rows.sparkSession.createDataFrame(places, "batch_id long, _last long, _first int, _parts int")
    task = F.col("_first") + (F.monotonically_increasing_id() % F.col("_parts")).cast("int")
    dealt = (rows.withColumn("batch_id", F.col("batch_id").cast("long")).join(F.broadcast(placed), "batch_id")
             .withColumn("_task", task).repartitionById(first, "_task")
             .withColumn("batch_id", F.col("_last")).drop("_last", "_first", "_parts", "_task"))
    with unsorted_partitions(rows.sparkSession):
        dealt.write.partitionBy("batch_id").mode("overwrite").format(fmt).options(**options).save(copy)


def check_packable(fmt: str) -> None:
    if fmt not in ("parquet", "json", "text"):
        raise ValueError(f"files of format {fmt} can't be packed")


def pack_files(spark: SparkSession, path: str, fmt: str = "parquet", target_bytes: int = TARGET_BYTES,
               upto: int | None = None, **options) -> int:
    """Pack the batches below ``path`` that :func:`feedworks.sinks.write_batch` wrote, up to
    batch ``upto`` or the last but one. Returns the number of runs.

    Parquet batches may differ in their columns, which the packed ones have all. JSON lines
    are moved as text. CSV is refused: its rows may go over lines, and files have heads.
    ``options`` are the writer's, like ``compression``.
    """
    check_packable(fmt)
    finish_files(spark, path)
    upto = _before_newest(newest_batch(spark, path), upto)
    runs = runs_to_pack(_sized(spark, path, upto), target_bytes)
    if not runs:
        return 0
    folders = [f"{path}/batch_id={number}" for run in runs for number, _, _ in run]
    reader = spark.read.option("basePath", path)
    # Where all batches of a format without a schema are empty, nothing tells the columns.
    held = sum(size for run in runs for _, size, _ in run)
    copy = f"{path}/{_COPY}"
    if fmt == "parquet":
        _write_runs(reader.option("mergeSchema", True).parquet(*folders), runs, target_bytes, copy, fmt, **options)
    elif held:
        _write_runs(reader.text(folders), runs, target_bytes, copy, "text", **options)
    else:
        delete(spark, copy)
    write_note(spark, path, _NOTE, {"runs": [[number for number, _, _ in run] for run in runs]})
    finish_files(spark, path)
    return len(runs)


def finish_files(spark: SparkSession, path: str) -> None:
    """Puts packed runs in the place of their batches, also when that had begun before."""
    for run in read_note(spark, path, _NOTE).get("runs", []):
        for number in run[:-1]:
            delete(spark, f"{path}/batch_id={number}")
        # Without a packed partition the run had no rows, or the partition has been moved already.
        move(spark, f"{path}/{_COPY}/batch_id={run[-1]}", f"{path}/batch_id={run[-1]}")
    if read_note(spark, path, _NOTE).get("runs"):
        write_note(spark, path, _NOTE, {})
        delete(spark, f"{path}/{_COPY}")


def pack_table(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES, upto: int | None = None) -> int:
    """Pack the batches of a table that a table sink wrote, up to batch ``upto`` or the last but
    one. Returns the number of runs. Logs of upsert tables are refused: their batches tell
    which row is newer."""
    if ORDER in spark.table(table).columns:
        raise ValueError(f"{table} belongs to an upsert table")
    finish_table(spark, table)
    folder = table_location(spark, table)
    upto = _before_newest(newest_table_batch(spark, table), upto)
    runs = runs_to_pack(_sized(spark, folder, upto), target_bytes)
    if not runs:
        return 0
    numbers = [[number for number, _, _ in run] for run in runs]
    spark.catalog.refreshTable(table)
    rows = spark.table(table).where(F.col("batch_id").isin([number for run in numbers for number in run]))
    _write_runs(rows, runs, target_bytes, f"{folder}/{_COPY}", "parquet")
    set_properties(spark, table, {_PACKING: json.dumps({"runs": numbers})})
    finish_table(spark, table)
    return len(runs)


def finish_table(spark: SparkSession, table: str) -> None:
    """As :func:`finish_files`, by a dynamic overwrite of the runs' last partitions."""
    runs = json.loads(properties(spark, table).get(_PACKING) or "{}").get("runs")
    if not runs:
        return
    folder = table_location(spark, table)
    copy = f"{folder}/{_COPY}"
    with unsorted_partitions(spark):
        overwrite_partitions(spark.read.schema(spark.table(table).schema).parquet(copy), table)
    drop_batch(spark, table, *[number for run in runs for number in run[:-1]])
    set_properties(spark, table, {_PACKING: ""})
    delete(spark, copy)
    spark.catalog.refreshTable(table)


def _before_newest(newest: int | None, upto: int | None) -> int:
    last = -1 if newest is None else newest - 1
    return last if upto is None else min(upto, last)

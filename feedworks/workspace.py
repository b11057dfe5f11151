"""Shared folder for staged inputs and intermediate tables.

Everything written between two Spark jobs goes below ``spark.checkpoint.dir`` or
the context's checkpoint folder, which every executor can reach. A local session
that has neither uses a folder below its warehouse.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_scratches: list[list[str]] = []


def root(spark: SparkSession) -> str:
    """The folder of this Spark application inside the shared folder."""
    context = spark.sparkContext
    base = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{base.rstrip('/')}/feedworks/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below :func:`root` that nothing has been written to."""
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _scratches:
        _scratches[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what has been written to new paths inside it. Frames
    that read such a table must have been written out before."""
    _scratches.append([])
    try:
        yield
    finally:
        for path in _scratches.pop():
            delete(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    Cuts the lineage and fixes row positions: two plans that read the result
    see the same rows in the same blocks, also when executors are lost.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of the partition folders ``<column>=<number>`` in ``path``."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def age_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a folder times that rise with their names: a file stream takes
    them in the order of their times."""
    fs, folder = _folder(spark, path)
    files = sorted(status.getPath().toString() for status in fs.listStatus(folder) if not status.getPath().getName().startswith(("_", ".")))
    for number, name in enumerate(files):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), 1_500_000_000_000 + 60_000 * number, -1)


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and number of the data files in a folder."""
    fs, folder = _folder(spark, path)
    files = [status for status in fs.listStatus(folder) if not status.getPath().getName().startswith(("_", "."))]
    return sum(status.getLen() for status in files), len(files)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Put the folder ``path``, if there is one, in the place of ``target``."""
    fs, folder = _folder(spark, path)
    if fs.exists(folder):
        _, place = _folder(spark, target)
        fs.delete(place, True)
        if not fs.rename(folder, place):
            raise OSError(f"{path} could not be moved to {target}")


def read_note(spark: SparkSession, path: str, name: str) -> dict:
    """The note ``name`` beside the data in ``path``; empty where there is none.
    File readers pass over it."""
    fs, note = _folder(spark, f"{path}/_{name}.json")
    if not fs.exists(note):
        return {}
    stream = fs.open(note)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, name: str, content: dict) -> None:
    """Replace a note. It is written beside the old one and takes its place by a rename."""
    fs, note = _folder(spark, f"{path}/_{name}.json")
    _, fresh = _folder(spark, f"{path}/_{name}.{uuid.uuid4().hex[:8]}.new")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(options, 1)
    overwrite[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(note).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(note), overwrite)


def release(spark: SparkSession) -> None:
    """Delete what this application has written below the shared folder."""
    delete(spark, root(spark))

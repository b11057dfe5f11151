"""Micro-batch jobs: a stream, a transformation and a sink.

Progress is kept in the checkpoint, one checkpoint per output. After a failure
the last batch may run again; the file, table and upsert sinks then replace what
it wrote before.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from feedworks.sinks import compact, create_or_append, keyed_upsert, write_batch, write_index
from feedworks.sinks.files import retract_batch
from feedworks.sinks.small_files import TARGET_BYTES, check_packable, finish_files, finish_table, pack_files, pack_table
from feedworks.sinks.tables import drop_batch, replace_batch
from feedworks.sinks.upsert import with_key

class _InputRows(StreamingQueryListener):
    """Adds up the source rows of every batch, by run of a query."""

    def __init__(self):
        self._changed = threading.Condition()
        self._rows: dict[str, dict[int, int]] = {}
        self._sums: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress, run_id = event.progress, str(event.progress.runId)
        with self._changed:
            # A trigger without new rows reports the batch to come again.
            latest = self._rows.setdefault(run_id, {"batch": -1})
            if progress.numInputRows or progress.batchId > latest["batch"]:
                self._sums[run_id] = self._sums.get(run_id, 0) + progress.numInputRows
            latest["batch"] = max(latest["batch"], progress.batchId)
            self._changed.notify_all()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def total(self, run_id: str, upto: int, patience: float = 30.0) -> int:
        """The sum once batch ``upto`` has been reported."""
        end = time.monotonic() + patience
        with self._changed:
            while self._rows.get(run_id, {"batch": -1})["batch"] < upto:
                if not self._changed.wait(max(0.0, end - time.monotonic())) and time.monotonic() >= end:
                    raise TimeoutError(f"no report of batch {upto}")
            return self._sums.get(run_id, 0)


_listeners: dict[int, _InputRows] = {}
_of_run: dict[str, _InputRows] = {}


def _listener(spark) -> _InputRows:
    # Python may have several objects for one session.
    key = spark._jvm.System.identityHashCode(spark._jsparkSession)
    if key not in _listeners:
        _listeners[key] = _InputRows()
        spark.streams.addListener(_listeners[key])
    return _listeners[key]


Sink = Callable[[DataFrame, int], None]


def run(source: DataFrame, sink: Sink, *, checkpoint: str,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        interval: str | None = "30 seconds", name: str | None = None,
        skip_empty: bool = False) -> StreamingQuery:
    """Start the job and return the running query.

    ``interval=None`` works off what is there, in batches bounded by the
    source's options, and ends. Sources fire no batch without
    new input; ``skip_empty`` also leaves out a batch whose input gives no row. Its rows are
    counted while file and table sinks write them, and what an empty batch wrote is taken
    back, so that this needs no job of its own. Other sinks don't see such a batch, at the price of a job
    that looks for its first row.
    """
    stream = transform(source) if transform else source
    listener = _listener(source.sparkSession)
    retract = getattr(sink, "retract", None)

    def each(batch: DataFrame, batch_id: int) -> None:
        if skip_empty and retract:
            seen = Observation()
            sink(batch.observe(seen, F.count(F.lit(1)).alias("rows")), batch_id)
            if not seen.get["rows"]:
                retract(batch.sparkSession, batch_id)
        elif not (skip_empty and batch.isEmpty()):
            sink(batch, batch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    query = writer.trigger(**trigger).start()
    _of_run[str(query.runId)] = listener
    return query


def input_rows(query: StreamingQuery) -> int:
    """Source rows that this run of the query has read, all batches counted: a listener
    adds them up as they are reported, however many reports Spark keeps."""
    last = query.lastProgress
    return _of_run[str(query.runId)].total(str(query.runId), last["batchId"]) if last else 0


def files_sink(path: str, fmt: str = "json", pack_every: int | None = None, target_bytes: int = TARGET_BYTES,
               **options) -> Sink:
    """Files in one partition per batch. Every ``pack_every`` batches the earlier ones are packed into
    files of about ``target_bytes``, see :mod:`feedworks.sinks.small_files`."""
    if pack_every:
        check_packable(fmt)
    kept = {name: value for name, value in options.items() if name == "compression"}

    def write(batch: DataFrame, batch_id: int) -> None:
        if pack_every:
            finish_files(batch.sparkSession, path)
        write_batch(batch, path, batch_id, fmt, **options)
        if _due(batch_id, pack_every):
            pack_files(batch.sparkSession, path, fmt, target_bytes, **kept)
    write.retract = lambda spark, batch_id: retract_batch(spark, path, batch_id)
    return write


def _due(batch_id: int, every: int | None) -> bool:
    return bool(every and batch_id and batch_id % every == 0)


def table_sink(table: str, path: str | None = None, per_batch: bool = True, grow: bool = False,
               pack_every: int | None = None, target_bytes: int = TARGET_BYTES) -> Sink:
    """Catalogue table, created by the first batch; ``grow`` lets it take on columns.

    With a partition per batch a repeated batch replaces itself, and earlier batches can be packed as
    :func:`files_sink` does. ``per_batch=False`` appends without such a column; a batch repeated after
    a failure is then there twice.
    """
    if per_batch:
        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            if pack_every and spark.catalog.tableExists(table):
                finish_table(spark, table)
            replace_batch(batch, table, batch_id, path, grow)
            if _due(batch_id, pack_every):
                pack_table(spark, table, target_bytes)
        write.retract = lambda spark, batch_id: drop_batch(spark, table, batch_id)
        return write

    def append(batch: DataFrame, batch_id: int) -> None:
        create_or_append(batch, table, path=path, grow=grow)
    return append


def upsert_sink(table: str, key: str | list[str], order_by: list[str] = (), mode: str | None = None,
                keyless: Sink | None = None, compact_every: int | None = 100, path: str | None = None,
                replay_safe: bool = False) -> Sink:
    """Keyed upsert table of the catalogue. Rows without a key go to ``keyless``; without such a sink they
    fail the batch. Every so many batches the table is compacted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if keyless:
            batch, others = with_key(batch, key)
            keyless(others, batch_id)
        keyed_upsert(batch, table, key, order_by, batch_id, mode, path, replay_safe=replay_safe)
        if _due(batch_id, compact_every):
            compact(batch.sparkSession, table)
    return write


def index_sink(options: dict[str, str], fmt: str = "es") -> Sink:
    """External index; with an upsert by id a repeated batch changes nothing."""
    return lambda batch, batch_id: write_index(batch, options, fmt)


def sinks_together(*sinks: Sink) -> Sink:
    """Several outputs from one reading and parsing of the batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def parted(good: Sink, broken: Sink, transform: Callable[[DataFrame], DataFrame], column: str) -> Sink:
    """For a stream of parsed records: rows with text in ``column`` go to ``broken``, the
    others through ``transform`` to ``good``, from one reading and parsing of the batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            broken(batch.where(F.col(column).isNotNull()).select(column), batch_id)
            good(transform(batch.where(F.col(column).isNull()).drop(column)), batch_id)
        finally:
            batch.unpersist()
    return write

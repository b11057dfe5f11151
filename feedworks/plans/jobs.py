"""The jobs, end to end. ``python -m feedworks <job> --help`` runs them."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedworks import workspace
from feedworks.operators import messages
from feedworks.operators.events import event_records, explode_events, flatten
from feedworks.operators.segments import catalogue_subjects
from feedworks.schema import CORRUPT
from feedworks.sinks import create_or_append, keyed_upsert, write_files, write_index
from feedworks.sinks.upsert import with_key
from feedworks.sources import (
    delimited, jdbc_table, kafka_messages, quarantined, well_formed, xml_event_rows, xml_records, xml_stream,
)
from feedworks.streaming import files_sink, run, sinks_together
from feedworks.streaming.run import Sink, parted


def xml_to_json(spark: SparkSession, source: str, archive: str, output: str,
                large_documents: bool = False) -> None:
    """Archive the raw feed as Parquet, then write its events as JSON.

    Each run is a partition ``load=…`` of the archive, broken records included. The
    events are made from that partition, so that the XML is parsed once.
    ``large_documents`` archives events instead of records.
    """
    with workspace.scratch(spark):
        records = _parsed(spark, source, large_documents)
        load = f"{archive}/load={uuid.uuid4().hex}"
        write_files(records, load)
    loaded = spark.read.schema(records.schema).parquet(load)
    write_files(flatten(_events(loaded, large_documents)), output, "json", mode="overwrite")


def xml_to_csv(spark: SparkSession, source: str, output: str, large_documents: bool = False,
               quarantine: str | None = None) -> None:
    """Append the events of a feed to CSV files, one column per leaf, and its broken
    records to JSON files in ``quarantine``, by default beside the output."""
    quarantine = quarantine or f"{output.rstrip('/')}{_QUARANTINE}"
    _part(spark, _parsed, source, large_documents, quarantine,
          lambda events: write_files(flatten(events), output, "csv"))


def xml_to_table(spark: SparkSession, source: str, table: str = "ng_events", raw: bool = True,
                 large_documents: bool = False, quarantine: str | None = None) -> DataFrame:
    """Create or extend a table with the events of a feed, as they are or flat, and
    ``quarantine``, by default a table named after it, with its broken records."""
    def write(events: DataFrame) -> None:
        create_or_append(events if raw else flatten(events, doc_id=False), table, view="events")

    _part(spark, _parsed, source, large_documents, None, write,
          lambda broken: create_or_append(broken, quarantine or f"{table}{_QUARANTINE}"))
    return spark.table(table)


_QUARANTINE = "_quarantine"


def _parsed(spark: SparkSession, source: str, large_documents: bool) -> DataFrame:
    """Records of a feed, or its events one by one where records are too large."""
    return xml_event_rows(spark, source) if large_documents else xml_records(spark, source)


def _events(parsed: DataFrame, large_documents: bool) -> DataFrame:
    return well_formed(parsed) if large_documents else explode_events(parsed)


def _part(spark: SparkSession, parse, source: str, large_documents: bool, folder: str | None, write, set_aside=None) -> None:
    """Write events and broken records from one parse of the feed."""
    with workspace.scratch(spark):
        parsed = parse(spark, source, large_documents).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(_events(parsed, large_documents))
            broken = quarantined(parsed)
            set_aside(broken) if set_aside else write_files(broken, folder, "json")
        finally:
            parsed.unpersist()


def csv_to_upsert(spark: SparkSession, source: str, table: str, key: str = "event_id",
                  order_by: list[str] = (), quarantine: str | None = None) -> int:
    """Insert or update the rows of CSV files with a header. Rows without a key go to
    the table ``quarantine``, by default one named after the table."""
    rows, keyless = with_key(delimited(spark, source), key)
    create_or_append(keyless, quarantine or f"{table}{_QUARANTINE}", grow=True)
    return keyed_upsert(rows, table, key, order_by)


def csv_to_index(spark: SparkSession, source: str, options: dict[str, str], fmt: str = "es") -> None:
    """Hand the rows of CSV files with a header to an index connector."""
    write_index(delimited(spark, source), options, fmt)


def jdbc_to_parquet(spark: SparkSession, url: str, table: str, output: str, **settings) -> None:
    """Append a database table to Parquet files."""
    write_files(jdbc_table(spark, url, table, **settings), output)


def catalogue_to_csv(spark: SparkSession, source: str, output: str, sep: str = "^") -> None:
    """Accession numbers with their subjects from a tab-separated export."""
    write_files(catalogue_subjects(delimited(spark, source, sep="\t")), output, "csv",
                mode="overwrite", sep=sep)


def xml_stream_to(spark: SparkSession, source: str, sink: Sink, checkpoint: str,
                  doc_id: bool = False, interval: str | None = "30 seconds",
                  quarantine: str | None = None, **options) -> StreamingQuery:
    """Events of the XML files arriving in a folder, to any sink; broken records to
    JSON files in ``quarantine``, a partition per batch, by default beside the checkpoint."""
    aside = files_sink(quarantine or f"{checkpoint.rstrip('/')}{_QUARANTINE}")
    return run(xml_stream(spark, source, **options),
               parted(sink, aside, lambda records: event_records(records, doc_id), CORRUPT),
               checkpoint=checkpoint, interval=interval)


def kafka_to(spark: SparkSession, servers: str, topic: str, sink: Sink, checkpoint: str,
             interval: str | None = "30 seconds", quarantine: str | None = None, keep: tuple[str, ...] = (), **settings) -> StreamingQuery:
    """Network and event ids of comma-separated messages, to any sink. The whole text of a
    message that does not fit also goes to ``quarantine``, by default beside the checkpoint.
    ``keep`` hands on columns of the log, as its place for a replay-safe upsert."""
    aside = files_sink(quarantine or f"{checkpoint.rstrip('/')}{_QUARANTINE}")

    def both(batch: DataFrame, batch_id: int) -> None:
        aside(batch.where(F.col(CORRUPT).isNotNull()).select(CORRUPT), batch_id)
        sink(batch.drop(CORRUPT), batch_id)

    return run(kafka_messages(spark, servers, topic, **settings), sinks_together(both), checkpoint=checkpoint,
               transform=lambda log: message_ids(log, CORRUPT, keep=keep), interval=interval)


def message_ids(log: DataFrame, *more: str, keep: tuple[str, ...] = ()) -> DataFrame:
    decoded = messages.decode_csv(log, keep=keep)
    return decoded.select(*keep, F.col("NETWORK_ID").alias("network_id"), F.col("EVENT_ID").alias("event_id"), *more)

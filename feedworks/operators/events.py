"""Traffic events: from feed records to one flat row per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedworks.functions import document_id
from feedworks.operators import nested
from feedworks.schema import EVENT_FIELDS


def explode_events(records: DataFrame) -> DataFrame:
    """One row per event: ``network_id``, ``network_name`` and the event as
    ``col``. Networks without events give no row, nor do corrupt records."""
    networks = records.select(F.explode("net").alias("net")).select(
        F.col("net._id").alias("network_id"), F.col("net._name").alias("network_name"),
        F.col("net.event").alias("event"))
    return networks.select("network_id", "network_name", F.explode("event").alias("col"))


def flatten(events: DataFrame, doc_id: bool = True, fields: dict | None = None,
            typed: bool = True) -> DataFrame:
    """The 21-column event record, or without ``doc_id`` the 20-column one.

    ``fields`` replaces or adds entries of the field map, e.g. another source
    for ``code4``. Times and coordinates are typed, and null where they do not
    parse; ``typed=False`` passes their text through, for feeds that write times
    in a form of their own.
    """
    keep = ["network_id", "network_name"]
    if doc_id:
        keep.insert(0, document_id(F.col("col._id")).alias("doc_id"))
    return nested.project(events, {**EVENT_FIELDS, **(fields or {})}, "col", keep, typed)


def event_records(records: DataFrame, doc_id: bool = True) -> DataFrame:
    """Feed records straight to flat event rows."""
    return flatten(explode_events(records), doc_id)

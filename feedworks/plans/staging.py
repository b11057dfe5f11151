"""Feeds staged from the test tables, so that the sources have something to read.

Each feed is written once per session and table folder, by Spark, whole, into
the shared folder. File counts follow the row counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.schema import ACCESSION_TAG, MESSAGE_COLUMNS, ROW_TAG
from feedworks.sinks.files import CSV_OPTIONS

EVENTS_PER_RECORD = 64
_RECORDS_PER_WHOLE_FILE = 256
_ROWS_PER_FILE = 250_000
_LEAST_FILES = 4

_staged: dict[tuple, str] = {}


def _once(write: Callable) -> Callable[[SparkSession, str], str]:
    @wraps(write)
    def path(spark: SparkSession, sf_dir: str) -> str:
        key = (workspace.root(spark), sf_dir, write.__name__)
        if key not in _staged:
            target = workspace.new_path(spark, write.__name__)
            write(spark, sf_dir, target)
            _staged[key] = target
        return _staged[key]
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_files(df: DataFrame) -> int:
    return max(_LEAST_FILES, -(-df.count() // _ROWS_PER_FILE))


#: What a feed takes from ``events``. Rows move as these; their XML, ten times as large, is made where it is written.
_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _text(column: Column) -> Column:
    return column.cast("string")


def _network_name(user: Column) -> Column:
    return F.concat(F.lit("user-"), _text(user))


def _feed_event(of: Callable[[str], Column]) -> Column:
    """An event in the shape of the feed; ``of`` gives the columns of its row."""
    kind, value, k = of("event_type"), of("value"), F.get_json_object(of("props"), "$.k")
    unless = lambda other, c: F.when(kind != other, c)
    return F.struct(
        _text(of("event_id")).alias("_id"),
        _text(of("ts")).alias("updateTimestamp"),
        _text(F.floor(value)).alias("severity"),
        kind.alias("updateType"),
        F.struct(k.alias("locationId"), _text(value).alias("lat"),
                 _text(0 - value / 2).alias("lon")).alias("primaryLoc"),
        F.when(kind == "error", "closed").otherwise("open").alias("status"),
        F.concat(F.lit("net-"), _text(of("user_id"))).alias("source"),
        unless("view", F.concat(F.lit("ops & <"), _text(of("user_id")), F.lit(">"))).alias("contact"),
        unless("signup", F.struct(F.concat(F.lit("M"), k).alias("code1"))).alias("messageCodes"),
        F.struct(_text(of("user_id") % 4).alias("_lane1"),
                 F.concat(F.lit("lane "), kind).alias("_VALUE")).alias("affectedLanes"),
        F.struct(kind.alias("_VALUE")).alias("type"),
        F.concat(F.lit("Événement "), kind).alias("typeDesc"),
        F.struct(F.when(value < 10, "dry").otherwise("wet").alias("_VALUE")).alias("roadCond"),
        F.struct(F.when(value < 5, "clear").otherwise("rain").alias("_VALUE")).alias("weatherCond"),
        _text(of("ts") - F.expr("INTERVAL '1' HOUR")).alias("startTimestamp"),
        unless("purchase", F.struct(k.alias("severity"), _text(of("ts")).alias("timestamp")))
        .alias("atisSeverity"))


#: A line per element; deep indents would be half of a feed.
_XML_OPTIONS = {"indent": " "}


def _xml(net: Column) -> Column:
    return F.to_xml(F.struct(net.alias("net")), {"rowTag": ROW_TAG, **_XML_OPTIONS})


def _records(events: DataFrame) -> DataFrame:
    """Records of at most EVENTS_PER_RECORD events, ids being unique; within a
    record the events stand below their networks. One shuffle."""
    def network(net: Column) -> Column:
        event = lambda row: _feed_event(lambda name: net["user_id"] if name == "user_id" else row[name])
        return F.struct(_text(net["user_id"]).alias("_id"), _network_name(net["user_id"]).alias("_name"),
                        F.transform(net["rows"], event).alias("event"))

    row = F.struct(*[c for c in _EVENT_COLUMNS if c != "user_id"])
    return (events.select(*_EVENT_COLUMNS, F.floor(F.col("event_id") / EVENTS_PER_RECORD).alias("record"))
            .repartition(n_files(events), "record")
            .groupBy("record", "user_id").agg(F.collect_list(row).alias("rows"))
            .groupBy("record").agg(F.collect_list(F.struct("user_id", "rows")).alias("nets"))
            .select("record", F.transform("nets", network).alias("net")))


@_once
def events_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``events`` as files of XML records, written over several lines each."""
    records = _records(table(spark, sf_dir, "events"))
    records.select(_xml(F.col("net")).alias("value")).write.text(path)


@_once
def wrapped_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``events`` as complete XML files, the records inside a root element; of a size at which
    a file can be read in one piece."""
    records = _records(table(spark, sf_dir, "events"))
    (records.select("net").write.format("xml")
     .options(rowTag=ROW_TAG, rootTag="feed", maxRecordsPerFile=_RECORDS_PER_WHOLE_FILE, **_XML_OPTIONS).save(path))


@_once
def events_xml_column(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``events`` as a table of XML texts, each inside a wrapper element."""
    wrapped = F.concat(F.lit("<feed>"), _xml(F.col("net")), F.lit("</feed>"))
    (_records(table(spark, sf_dir, "events")).select("record", wrapped.alias("document"))
     .write.parquet(path))


@_once
def broken_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A record per event, whole for views. Those of errors have an element that is not
    closed, those of purchases lack the end of the record, those of signups have a
    damaged start tag, and those of clicks, last in their files, are cut off: within
    the event, or for odd ids after the network."""
    events = table(spark, sf_dir, "events")
    kind, cut, user = F.col("event_type"), F.col("event_type") == "click", F.col("user_id")
    xml = F.trim(_xml(F.array(F.struct(_text(user).alias("_id"), _network_name(user).alias("_name"),
                                       F.array(_feed_event(F.col)).alias("event")))))
    after_child = F.concat(F.substring_index(xml, "</severity>", 1), F.lit("</severity>"))
    after_net = F.concat(F.substring_index(xml, "</net>", 1), F.lit("</net>"))
    broken = (F.when(kind == "error", F.regexp_replace(xml, "</status>", ""))
              .when(kind == "purchase", F.regexp_replace(xml, r"(?s)</source>.*$", ""))
              .when(kind == "signup", F.regexp_replace(xml, "^<eventData>", "<evntData>"))
              .when(cut, F.when(F.col("event_id") % 2 == 0, after_child).otherwise(after_net))
              .otherwise(xml))
    # A damaged start tag behind a cut-off record would be part of that record.
    rank = F.when(cut, 2).when(kind == "purchase", 1).otherwise(0)
    (events.select(*_EVENT_COLUMNS, rank.alias("rank")).repartition(n_files(events), "event_id")
     .sortWithinPartitions("rank", "event_id").select(broken.alias("value")).write.text(path))


@_once
def half_empty_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The feed, and as many files again of networks without events."""
    events = table(spark, sf_dir, "events")
    feed, n = _records(events).select(_xml(F.col("net")).alias("value")), n_files(events)
    networks = F.lit(f'<{ROW_TAG}><net id="1"></net></{ROW_TAG}>')
    feed.union(spark.range(0, n, 1, n).select(networks.alias("value"))).write.text(path)


@_once
def event_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``events`` as they are, in several files."""
    events = table(spark, sf_dir, "events")
    events.repartition(n_files(events)).write.parquet(path)


@_once
def large_document(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``events`` as a single document over all files, a network per user."""
    events = table(spark, sf_dir, "events")
    user, networks = F.col("user_id"), events.select("user_id").distinct()
    name = F.to_xml(F.struct(_text(user).alias("_id"), _network_name(user).alias("_name")), {"rowTag": "net"})
    # Lines of a network: 0 its start, 1 its events, 2 its end.
    kinds = [networks.select("user_id", F.lit(number).alias("line"), F.lit(-1).cast("long").alias("event_id")) for number in (0, 2)]
    lines = events.select(*_EVENT_COLUMNS, F.lit(1).alias("line"))
    for ends in kinds:
        lines = lines.unionByName(ends, allowMissingColumns=True)
    value = (F.when(F.col("line") == 0, F.regexp_replace(name, r"\s*/>\s*$|>\s*</net>\s*$", ">"))
             .when(F.col("line") == 1, F.to_xml(_feed_event(F.col), {"rowTag": "event", **_XML_OPTIONS}))
             .otherwise("</net>"))
    (lines.withColumn("_id", _text(user)).repartitionByRange(n_files(events), "_id", "line", "event_id")
     .sortWithinPartitions("_id", "line", "event_id").select(value.alias("value")).write.text(path))
    workspace.age_in_order(spark, path)


@_once
def turn_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``conversations`` in files that arrive in the order of turns."""
    turns = table(spark, sf_dir, "conversations")
    turns.repartitionByRange(n_files(turns), "turn", "conv_id").write.parquet(path)
    workspace.age_in_order(spark, path)


@_once
def catalogue_tsv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``conversations`` as a catalogue export in (conv_id, turn) order: answers
    close a group, other turns are its numbered subject lines."""
    turns = table(spark, sf_dir, "conversations")
    tag = F.when(F.col("role") == "assistant", F.concat(F.lit(ACCESSION_TAG + " "), F.col("conv_id"))
                 ).otherwise(F.col("role"))
    line = F.concat(F.col("turn").cast("string"), F.lit(". "), F.regexp_replace("text", r"[\t\r\n]+", " "))
    (turns.repartitionByRange(n_files(turns), "conv_id", "turn").sortWithinPartitions("conv_id", "turn")
     .select(tag.alias("Tag"), line.alias("Text")).write.options(sep="\t", header=True, **CSV_OPTIONS).csv(path))


@_once
def messages_text(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``orders`` as comma-separated messages of 26 fields; the description holds
    a comma, the fields of the second location are empty."""
    key, date = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    filled = {
        "EVENT_RECORD_ID": key, "EVENT_ID": F.concat(F.lit("E"), key),
        "NETWORK_ID": F.col("o_custkey").cast("string"), "EVENT_CATEGORY_ID": F.col("o_orderstatus"),
        "EVENT_SEVERITY_ID": F.substring("o_orderpriority", 1, 1), "UPDATE_TIME": date,
        "PRI_LOCATION_RECORD": F.concat(F.lit("R"), key), "EVENT_STATUS_ID": F.col("o_orderstatus"),
        "EVENT_DESC": F.concat(F.lit("priority "), F.col("o_orderpriority"), F.lit(", "), date),
    }
    fields = [filled.get(c, F.lit("p" if c.startswith("PRI") else None).cast("string")).alias(c)
              for c in MESSAGE_COLUMNS]
    orders = table(spark, sf_dir, "orders")
    orders.repartition(n_files(orders)).select(
        F.to_csv(F.struct(*fields)).alias("value")).write.text(path)


@_once
def message_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The messages in the columns of a Kafka source, values as bytes."""
    lines = spark.read.text(messages_text(spark, sf_dir))
    (lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                  F.lit("events").alias("topic"),
                  F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
                  F.current_timestamp().alias("timestamp")).write.parquet(path))

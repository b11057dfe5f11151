"""The registered queries: each reads the test tables, or a feed staged from
them, through the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.functions import is_subject_line
from feedworks.operators import messages, nested
from feedworks.operators.events import event_records, explode_events, flatten
from feedworks.operators.segments import catalogue_subjects, fold
from feedworks.plans import jobs, staging
from feedworks.plans.jobs import message_ids
from feedworks.plans.staging import table
from feedworks.schema import CORRUPT, SUBJECT_COLUMNS
from feedworks.sinks import (
    compact, create_or_append, current_state, keyed_upsert, to_json_lines, write_files,
)
from feedworks.sinks.files import CSV_OPTIONS, JSON_OPTIONS
from feedworks.sources import (
    as_messages, delimited, parse_xml_column, xml_event_rows, xml_event_stream, xml_records, xml_stream,
)
from feedworks.streaming import event_rows_sink, files_sink, fold_sink, input_rows, run, table_sink, upsert_sink


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return xml_records(spark, staging.events_xml(spark, sf_dir))


def xml_events_21(spark, sf_dir):
    return nested.flatten_structs(event_records(_feed(spark, sf_dir)))


def xml_events_20(spark, sf_dir):
    return nested.flatten_structs(event_records(_feed(spark, sf_dir), doc_id=False))


def xml_events_raw(spark, sf_dir):
    """Leaves are text; numbers and times are cast for comparison only."""
    raw = nested.flatten_structs(explode_events(_feed(spark, sf_dir)))
    types = {"lat": "double", "lon": "double", "updateTimestamp": "timestamp_ntz",
             "startTimestamp": "timestamp_ntz", "timestamp": "timestamp_ntz"}
    return raw.select(*[F.col(c).cast(types.get(c.split("_")[-1], "string")).alias(c)
                        for c in raw.columns])


def xml_wrapped_files(spark, sf_dir):
    wrapped = xml_records(spark, staging.wrapped_xml(spark, sf_dir))
    return nested.flatten_structs(event_records(wrapped))


def xml_whole_files(spark, sf_dir):
    wrapped = xml_records(spark, staging.wrapped_xml(spark, sf_dir), whole_files=True)
    return nested.flatten_structs(event_records(wrapped, doc_id=False))


def xml_column_parse(spark, sf_dir):
    documents = spark.read.parquet(staging.events_xml_column(spark, sf_dir))
    return nested.flatten_structs(event_records(parse_xml_column(documents, "document")))


def _event_in(text):
    return F.regexp_extract(text, '<event id="([0-9]+)"', 1)


def xml_corrupt_split(spark, sf_dir):
    records = xml_records(spark, staging.broken_xml(spark, sf_dir))
    broken = F.col(CORRUPT).isNotNull()
    return records.select(
        F.when(broken, "quarantined").otherwise("good").alias("outcome"),
        F.when(broken, _event_in(F.col(CORRUPT)))
        .otherwise(F.col("net")[0]["event"][0]["_id"]).alias("event_id"),
        F.col("net")[0]["event"][0]["updateType"].alias("update_type"))


def xml_corrupt_events(spark, sf_dir):
    """The same files, event by event: an event is whole where only its record is broken."""
    events = xml_event_rows(spark, staging.broken_xml(spark, sf_dir))
    broken = F.col(CORRUPT).isNotNull()
    return events.select(
        F.when(broken, "quarantined").otherwise("good").alias("outcome"),
        F.when(broken, _event_in(F.col(CORRUPT))).otherwise(F.col("col._id")).alias("event_id"))


def xml_large_document(spark, sf_dir):
    rows = xml_event_rows(spark, staging.large_document(spark, sf_dir), across_files=True)
    return nested.flatten_structs(flatten(rows))


def raw_archive_roundtrip(spark, sf_dir):
    archive = workspace.new_path(spark, "archive")
    write_files(_feed(spark, sf_dir), archive)
    return nested.flatten_structs(event_records(spark.read.parquet(archive)))


def json_roundtrip(spark, sf_dir):
    path = workspace.new_path(spark, "events-json")
    flat = event_records(_feed(spark, sf_dir))
    write_files(flat, path, "json", mode="overwrite")
    return nested.flatten_structs(spark.read.schema(flat.schema).options(**JSON_OPTIONS).json(path))


def csv_flat_roundtrip(spark, sf_dir):
    path = workspace.new_path(spark, "events-csv")
    flat = event_records(_feed(spark, sf_dir))
    write_files(flat, path, "csv")
    columns = nested.flatten_structs(flat).schema
    return delimited(spark, path, schema=columns, header=False, **CSV_OPTIONS)


def csv_strings(spark, sf_dir):
    """Header-named strings, as from any CSV file with a header."""
    path = workspace.new_path(spark, "supplier-csv")
    write_files(table(spark, sf_dir, "supplier"), path, "csv", header=True)
    return delimited(spark, path)


def json_lines(spark, sf_dir):
    path = workspace.new_path(spark, "orders-json")
    orders = table(spark, sf_dir, "orders")
    to_json_lines(orders, path)
    line = F.from_json("value", orders.schema, {"timestampNTZFormat": JSON_OPTIONS["timestampNTZFormat"]})
    return (spark.read.text(path)
            .select(F.size(F.json_object_keys("value")).alias("n_keys"), line.alias("row"))
            .select("n_keys", "row.*"))


def positional_rename(spark, sf_dir):
    return nested.rename_positional(
        table(spark, sf_dir, "supplier"), ["event_id", "network_name", "network_id", "severity"])


def segments_conversations(spark, sf_dir):
    answer = F.col("role") == "assistant"
    return fold(table(spark, sf_dir, "conversations"), partition_by=["conv_id"], order=["turn"],
                block=F.expr("turn div 1000"), is_end=answer, keep=F.col("text").isNotNull(),
                key=F.col("text"), value=F.col("text"), names=("answer", "before"))


def segments_order_ranges(spark, sf_dir):
    """All conversations as one sequence, in ranges of (conv_id, turn)."""
    answer = F.col("role") == "assistant"
    return fold(table(spark, sf_dir, "conversations"), order=["conv_id", "turn"],
                is_end=answer & (F.col("turn") > 2), keep=F.col("role") == "user",
                key=F.col("conv_id"), value=F.col("turn").cast("string"), names=("conv_id", "turns"))


def segments_file_order(spark, sf_dir):
    export = delimited(spark, staging.catalogue_tsv(spark, sf_dir), sep="\t")
    path = workspace.new_path(spark, "subjects")
    write_files(catalogue_subjects(export, across_files=True), path, "csv", mode="overwrite", sep="^")
    # With another text for nulls the reader tells an empty text from a null.
    return delimited(spark, path, sep="^", header=False, nullValue="\\N",
                     schema=", ".join(f"{c} string" for c in SUBJECT_COLUMNS), **CSV_OPTIONS)


def subject_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(is_subject_line(F.col("text"))).select("doc_id")


def _without_table(spark, name, path):
    """The rows of an external table, which is dropped; its files stay."""
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def table_create_append(spark, sf_dir):
    name = f"feedworks_events_{uuid.uuid4().hex[:12]}"
    path = workspace.new_path(spark, "table")
    flat = workspace.materialise(event_records(_feed(spark, sf_dir), doc_id=False), "flat")
    closed = F.coalesce(F.col("status") == "closed", F.lit(False))
    create_or_append(flat.where(closed), name, path=path)
    late = flat.where(~closed)
    create_or_append(late.select(*reversed(late.columns)), name, view="feedworks_late_events")
    return nested.flatten_structs(_without_table(spark, name, path))


def files_by_number(spark, sf_dir):
    path = workspace.new_path(spark, "three-files")
    write_files(table(spark, sf_dir, "part"), path, "json", mode="overwrite", n_files=3)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"))
    return lines.agg(F.countDistinct("file").alias("n_files"), F.count("*").alias("n_rows"))


# Batches of the upsert queries: a kind of event arrives at a time.
_ARRIVALS = ["view", "error", "signup", "click", "purchase"]


def _upsert_table(spark) -> dict:
    """Name and place of a new table."""
    return {"table": f"feedworks_upsert_{uuid.uuid4().hex[:12]}", "path": workspace.new_path(spark, "upsert")}


def _state_of(spark, place, key=None, mode=None) -> DataFrame:
    """The state of a table, which is dropped."""
    state = workspace.materialise(current_state(spark, place["table"], key, mode), "state")
    for name in (place["table"], f"{place['table']}_log"):
        spark.sql(f"DROP TABLE {name}")
    return state


def _arrivals(spark, sf_dir) -> dict:
    """An upsert table by user; errors come without a value."""
    place = _upsert_table(spark)
    events = table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value")))
    for number, kind in enumerate(_ARRIVALS):
        keyed_upsert(events.where(F.col("event_type") == kind), key="user_id",
                     order_by=["ts", "event_id"], batch_id=number, **place)
    return place


def upsert_replace(spark, sf_dir):
    return _state_of(spark, _arrivals(spark, sf_dir), "user_id", mode="replace")


def _late_errors(spark, sf_dir) -> DataFrame:
    """Errors last, so that their missing values meet older ones."""
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type") == "error").withColumn("value", F.lit(None).cast("double"))


def upsert_merge(spark, sf_dir):
    place = _arrivals(spark, sf_dir)
    keyed_upsert(_late_errors(spark, sf_dir), key="user_id", order_by=["ts", "event_id"], **place)
    return _state_of(spark, place, "user_id")


def upsert_compacted(spark, sf_dir):
    place = _arrivals(spark, sf_dir)
    compact(spark, place["table"], "user_id")
    keyed_upsert(_late_errors(spark, sf_dir), key="user_id", order_by=["ts", "event_id"], **place)
    return _state_of(spark, place, "user_id")


def upsert_replace_compacted(spark, sf_dir):
    """Errors, whose values are missing, come last; a compaction before and after them
    changes nothing."""
    place = _upsert_table(spark)
    events = table(spark, sf_dir, "events")
    keyed_upsert(events.where("event_type != 'error'"), key="user_id", order_by=["ts", "event_id"], mode="replace", **place)
    compact(spark, place["table"])
    keyed_upsert(_late_errors(spark, sf_dir), key="user_id", order_by=["ts", "event_id"], **place)
    compact(spark, place["table"])
    return _state_of(spark, place)


def upsert_replayed(spark, sf_dir):
    """Events by kind, some of which come again later in a batch of their own, before and after
    a compaction: of each user the row with the newest time counts, whichever batch brought it."""
    place = _upsert_table(spark)
    events = table(spark, sf_dir, "events")
    how = {"key": "user_id", "order_by": ["ts", "event_id"], "replay_safe": True, **place}
    for kind in _ARRIVALS[:3]:
        keyed_upsert(events.where(F.col("event_type") == kind), **how)
    compact(spark, place["table"])
    keyed_upsert(events.where(F.col("event_type").isin(_ARRIVALS[:2])), **how)
    keyed_upsert(events.where(F.col("event_type").isin(_ARRIVALS[2:])), **how)
    return _state_of(spark, place, "user_id")


def upsert_new_column(spark, sf_dir):
    """The second batch brings a column that the first one lacks."""
    place = _upsert_table(spark)
    events = table(spark, sf_dir, "events")
    keyed_upsert(events.select("event_id", "event_type"), key="event_id", **place)
    keyed_upsert(events.where("event_type = 'click'").select("event_id", "value"), key="event_id", **place)
    return _state_of(spark, place, "event_id")


def upsert_from_csv(spark, sf_dir):
    """A CSV file with header into a table keyed by a text column."""
    path, place = workspace.new_path(spark, "parts-csv"), _upsert_table(spark)
    parts = table(spark, sf_dir, "part")
    write_files(parts.select(F.col("p_name").alias("event_id"), "p_partkey", "p_brand", "p_type"),
                path, "csv", header=True)
    rows = delimited(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("long"))
    keyed_upsert(rows, key="event_id", order_by=["p_partkey"], **place)
    return _state_of(spark, place, "event_id")


def _work_off(spark, stream, sink, transform) -> None:
    query = run(stream, sink, transform=transform, interval=None,
                checkpoint=workspace.new_path(spark, "checkpoint"))
    query.awaitTermination()


def _feed_stream(spark, sf_dir) -> DataFrame:
    """The staged feed in about four batches."""
    files = -(-staging.n_files(table(spark, sf_dir, "events")) // 4)
    return xml_stream(spark, staging.events_xml(spark, sf_dir), maxFilesPerTrigger=files)


def stream_xml_json(spark, sf_dir):
    path = workspace.new_path(spark, "stream-json")
    stream = _feed_stream(spark, sf_dir)
    _work_off(spark, stream, files_sink(path), event_records)
    schema = event_records(stream).schema
    events = spark.read.schema(schema).options(**JSON_OPTIONS).json(path).drop("batch_id")
    return nested.flatten_structs(events)


def stream_large_document(spark, sf_dir):
    """The document that goes on over all files, which arrive one by one."""
    path = workspace.new_path(spark, "stream-json")
    document = staging.large_document(spark, sf_dir)
    stream = xml_event_stream(spark, document, maxFilesPerTrigger=1)
    write = files_sink(path)
    sink = event_rows_sink(lambda rows, batch_id: write(flatten(rows), batch_id), workspace.new_path(spark, "state"))
    _work_off(spark, stream, sink, None)
    # The schema of any feed, for which nothing is read.
    schema = event_records(xml_records(spark, document)).schema
    return nested.flatten_structs(spark.read.schema(schema).options(**JSON_OPTIONS).json(path).drop("batch_id"))


def stream_segments(spark, sf_dir):
    """Conversations of which each batch brings some turns."""
    source, path = staging.turn_files(spark, sf_dir), workspace.new_path(spark, "stream-segments")
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    sink = fold_sink(files_sink(path, "parquet"), workspace.new_path(spark, "state"), partition_by=["conv_id"], order=["turn"],
                     block=F.expr("turn div 1000"), is_end=F.col("role") == "assistant", keep=F.col("text").isNotNull(),
                     key=F.col("text"), value=F.col("text"), names=("answer", "before"))
    _work_off(spark, stream, sink, None)
    return spark.read.parquet(path).drop("batch_id")


def table_new_columns(spark, sf_dir):
    """A table made of narrow events, which later events widen: by name, with new columns,
    and with numbers of a narrower type."""
    name, path = f"feedworks_grown_{uuid.uuid4().hex[:12]}", workspace.new_path(spark, "table")
    events = table(spark, sf_dir, "events")
    clicks = F.col("event_type") == "click"
    create_or_append(events.where(~clicks).select("event_id", "user_id", "value"), name, path=path)
    late = events.where(clicks).select("event_type", F.col("value").cast("float").alias("value"), "event_id")
    create_or_append(late, name, grow=True)
    return _without_table(spark, name, path)


def stream_xml_quarantine(spark, sf_dir):
    """The streaming job over broken files: its events, and what it has set aside."""
    path, aside = workspace.new_path(spark, "stream-good"), workspace.new_path(spark, "stream-aside")
    jobs.xml_stream_to(spark, staging.broken_xml(spark, sf_dir), files_sink(path), workspace.new_path(spark, "checkpoint"),
                       interval=None, quarantine=aside).awaitTermination()
    good = spark.read.schema("event_id string").json(path).select(F.lit("good").alias("outcome"), "event_id")
    broken = spark.read.schema(f"{CORRUPT} string").option("columnNameOfCorruptRecord", "_unread").json(aside)
    return good.unionByName(broken.select(F.lit("quarantined").alias("outcome"), _event_in(F.col(CORRUPT)).alias("event_id")))


def stream_row_counts(spark, sf_dir):
    """The source rows of a stream in several batches."""
    path = staging.event_files(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = run(stream, lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save(), interval=None,
                checkpoint=workspace.new_path(spark, "checkpoint"))
    query.awaitTermination()
    return spark.range(1).select(F.lit(input_rows(query)).cast("long").alias("n_rows"))


def _streamed_ids(spark, path):
    return spark.read.schema("event_id string").json(path).select("event_id")


def stream_skip_empty(spark, sf_dir):
    """Half of the batches have networks without events; the sink never sees those."""
    path = workspace.new_path(spark, "stream-json")
    stream = xml_stream(spark, staging.half_empty_xml(spark, sf_dir), maxFilesPerTrigger=1)

    def sink(batch, batch_id):
        if batch.isEmpty():
            raise ValueError(f"batch {batch_id} is empty")
        files_sink(path)(batch, batch_id)

    query = run(stream, sink, transform=event_records, interval=None, skip_empty=True,
                checkpoint=workspace.new_path(spark, "checkpoint"))
    query.awaitTermination()
    return _streamed_ids(spark, path)


def stream_interval(spark, sf_dir):
    """A trigger by processing time, stopped when everything has been read."""
    path = workspace.new_path(spark, "stream-json")
    query = run(_feed_stream(spark, sf_dir), files_sink(path), transform=event_records, interval="1 second",
                checkpoint=workspace.new_path(spark, "checkpoint"))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _streamed_ids(spark, path)


def stream_xml_table(spark, sf_dir):
    name = f"feedworks_stream_{uuid.uuid4().hex[:12]}"
    path = workspace.new_path(spark, "stream-table")
    sink = table_sink(name, path)
    _work_off(spark, _feed_stream(spark, sf_dir), sink, lambda df: event_records(df, doc_id=False))
    return nested.flatten_structs(_without_table(spark, name, path).drop("batch_id"))


def _event_stream(spark, sf_dir) -> DataFrame:
    """``events`` in about eight batches."""
    path = staging.event_files(spark, sf_dir)
    files = -(-staging.n_files(table(spark, sf_dir, "events")) // 8)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_files_packed(spark, sf_dir):
    """Files of batches that are packed every third one, as lines of JSON."""
    path, events = workspace.new_path(spark, "stream-packed"), _event_stream(spark, sf_dir)
    _work_off(spark, events, files_sink(path, pack_every=3), None)
    return spark.read.schema(events.schema).options(**JSON_OPTIONS).json(path).drop("batch_id")


def stream_table_packed(spark, sf_dir):
    """A table of batches that are packed every third one."""
    name, path = f"feedworks_packed_{uuid.uuid4().hex[:12]}", workspace.new_path(spark, "stream-table")
    _work_off(spark, _event_stream(spark, sf_dir), table_sink(name, path, pack_every=3), None)
    return _without_table(spark, name, path).drop("batch_id")


def stream_xml_upsert(spark, sf_dir):
    place = _upsert_table(spark)
    sink = upsert_sink(key="event_id", order_by=["update_timestamp"], **place)
    _work_off(spark, _feed_stream(spark, sf_dir), sink, lambda df: event_records(df, doc_id=False))
    return _state_of(spark, place, "event_id")


def stream_messages_ids(spark, sf_dir):
    place = _upsert_table(spark)
    log = staging.message_log(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
    _work_off(spark, as_messages(stream), upsert_sink(key="event_id", **place), message_ids)
    return _state_of(spark, place, "event_id")


def messages_decode_26(spark, sf_dir):
    return messages.decode_csv(spark.read.text(staging.messages_text(spark, sf_dir)))


def messages_decode_plain(spark, sf_dir):
    return messages.decode_csv(spark.read.text(staging.messages_text(spark, sf_dir)), quoting=False)


def messages_overflow(spark, sf_dir):
    """Every third message has fields too many; these are told apart, with their whole text."""
    lines = spark.read.text(staging.messages_text(spark, sf_dir))
    key = F.substring_index("value", ",", 1).cast("long")
    longer = lines.select(F.when(key % 3 == 0, F.concat("value", F.lit(",one,two"))).otherwise(F.col("value")).alias("value"))
    decoded = messages.decode_csv(longer)
    return decoded.select(F.col("EVENT_ID").alias("event_id"),
                          F.when(F.col(CORRUPT).isNull(), "good").otherwise("set aside").alias("outcome"),
                          F.regexp_extract(CORRUPT, ",([^,]*,[^,]*)$", 1).alias("beyond"))


def preview_top_n(spark, sf_dir):
    flat = nested.flatten_structs(event_records(_feed(spark, sf_dir)))
    return nested.first_rows(flat, 10, [F.col("update_timestamp").desc(), "event_id"])


QUERIES = {f.__name__: f for f in [
    xml_events_21, xml_events_20, xml_events_raw, xml_wrapped_files, xml_whole_files,
    xml_column_parse, xml_corrupt_split, xml_corrupt_events, xml_large_document, raw_archive_roundtrip,
    json_roundtrip, csv_flat_roundtrip, csv_strings, json_lines, positional_rename,
    segments_conversations, segments_order_ranges, segments_file_order, subject_lines,
    table_create_append, files_by_number, upsert_replace, upsert_merge, upsert_compacted,
    upsert_replace_compacted, upsert_replayed, upsert_new_column, upsert_from_csv,
    stream_large_document, stream_segments, table_new_columns, stream_xml_json, stream_xml_table, stream_xml_upsert, stream_xml_quarantine,
    stream_files_packed, stream_table_packed,
    stream_row_counts, stream_skip_empty, stream_interval,
    stream_messages_ids, messages_decode_26, messages_decode_plain, messages_overflow, preview_top_n,
]}

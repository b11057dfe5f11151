"""XML event documents, read in splits.

The built-in XML reader takes a file per task and gives up at the first broken
record. Here the text source ends a row within the record's end tag, so that one
file is split over many tasks, and every record is parsed on its own. The row
keeps the ``<`` of its end tag: a row without one is the cut-off end of a file.
Text with an end tag that belongs to no start tag becomes a corrupt row.

Limits: the row tag must not nest in itself nor occur in comments or CDATA (such
records come out corrupt, in parts), and files are split only where the end tag
is written without blanks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks import workspace
from feedworks.functions import bound, cut_at_end, start_tag, stray, tag_pieces, xml_fragments
from feedworks.operators.ordered import BLOCK, FILE, POSITION, carry_forward
from feedworks.schema import CORRUPT, EVENT, EVENT_RECORD, NETWORK, ROW_TAG, with_corrupt

# An age no file has reached; the file source would pass over files of a week.
_ANY_AGE = "36500d"

# Blanks around text belong to the text, as in the feed's earlier consumers.
_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
          "ignoreSurroundingSpaces": "false"}


def _parse_fragments(df: DataFrame, text, schema: T.StructType, row_tag: str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    # Parsing inside the generator: a filter on the parsed columns, also one that
    # Catalyst infers for a later explode, would otherwise be pushed below the
    # projection and parse every record once more.
    records = F.transform(xml_fragments(text, row_tag), lambda x: _parsed(x, schema, row_tag))
    return df.select(*keep, F.inline(records))


def _parsed(fragment, schema: T.StructType, row_tag: str):
    schema = with_corrupt(schema)
    return F.when(fragment.startswith(f"<{row_tag}"), F.from_xml(fragment, schema, _PARSE)).otherwise(_set_aside(fragment, schema))


def _set_aside(text, schema: T.StructType):
    """A record of ``schema`` that holds nothing but corrupt text."""
    return F.struct(*[(text if f.name == CORRUPT else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def _end_tag(tag: str) -> str:
    return f"</{tag}>"


def _line_end(tag: str) -> str:
    return f"/{tag}>"


def _closed(tag: str):
    """The text source strips the line end; put it back where there was one."""
    return F.when(F.col("value").endswith("<"), F.concat("value", F.lit(_line_end(tag)))).otherwise(F.col("value"))


def xml_records(spark: SparkSession, path: str | list[str],
                schema: T.StructType = EVENT_RECORD, row_tag: str = ROW_TAG,
                whole_files: bool = False, **options) -> DataFrame:
    """One row per ``row_tag`` element, with broken ones in ``_corrupt_record``.

    ``whole_files`` reads each file in one piece and leaves out comments: for
    small files whose row tag occurs in comments.
    """
    if whole_files:
        files = spark.read.options(**options).text(path, wholetext=True)
        text = F.regexp_replace("value", r"(?s)<!--.*?-->", "")
        # A generator holds all it makes of a row: of a whole file these are texts, and parsed is one at a time.
        fragments = files.select(F.explode(xml_fragments(text, row_tag)).alias("_fragment"))
        return fragments.select(F.inline(F.array(_parsed(F.col("_fragment"), schema, row_tag))))
    lines = spark.read.options(lineSep=_line_end(row_tag), **options).text(path)
    return _parse_fragments(lines, _closed(row_tag), schema, row_tag)


def xml_stream(spark: SparkSession, path: str, schema: T.StructType = EVENT_RECORD,
               row_tag: str = ROW_TAG, **options) -> DataFrame:
    """Stream of the records of files arriving in ``path``.

    Takes the file source's options, e.g. ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` to bound a batch after a long pause. Files count as
    new whatever their time; set ``maxFileAge`` for folders in which the driver
    can't remember all files it has seen.
    """
    options = {"maxFileAge": _ANY_AGE, **options}
    lines = spark.readStream.options(lineSep=_line_end(row_tag), **options).text(path)
    return _parse_fragments(lines, _closed(row_tag), schema, row_tag)


def parse_xml_column(df: DataFrame, column: str, schema: T.StructType = EVENT_RECORD,
                     row_tag: str = ROW_TAG, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of the XML text in ``column``, beside the columns in ``keep``.

    The record may be the root of the text, sit inside a wrapper, or be one of
    several that follow each other.
    """
    return _parse_fragments(df, F.col(column), schema, row_tag, keep)


def well_formed(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _event_tokens(text, event: T.StructType):
    """The tokens of ``text`` in order, parsed: networks, events, and what is stray, text
    with the end of an event that never began. Array of structs.

    Everything is worked out once per token here, within the generator that makes rows of
    the tokens. A projection above the generator would work it out again for every row.
    """
    no_net, broken = F.lit(None).cast(NETWORK), with_corrupt(event)
    # A tag cut off half-way is reported, and its events get no network rather than the
    # one before.
    unknown = F.struct(*[F.lit(None).cast("string").alias(n) for n in NETWORK.names])

    def token(net=no_net, stray_text=False, parsed=F.lit(None).cast(broken)):
        return F.struct(net.alias("_net"), F.lit(stray_text).alias("_stray"), parsed.alias("_event"))

    def strays(rest):
        return F.transform(stray(rest, "event"), lambda x: token(stray_text=True, parsed=_set_aside(x, broken)))

    def network(piece):
        # As an empty element the start tag of a network parses on its own.
        return bound(start_tag(piece, "net"), lambda tag: F.when(tag == "", F.array(token(unknown, parsed=_set_aside(piece, broken)))).otherwise(
            F.concat(F.array(token(_network(tag, unknown))),
                     strays(F.substring(piece, F.char_length(tag) + 1, F.char_length(piece))))))

    def one_event(piece):
        parse = lambda x: token(parsed=F.from_xml(x, broken, _PARSE))
        return bound(start_tag(piece, "event"), lambda tag: F.when(
            tag.endswith("/>"), F.concat(F.array(parse(tag)), strays(F.substring(piece, F.char_length(tag) + 1, F.char_length(piece)))),
        ).otherwise(bound(cut_at_end(piece, "event"), lambda parts: F.when(
            F.size(parts) > 1, F.concat(F.array(parse(F.concat(F.get(parts, F.lit(0)), F.lit(_end_tag("event"))))), strays(F.get(parts, F.lit(1)))),
        ).otherwise(F.array(parse(piece))))))

    return F.flatten(F.transform(tag_pieces(text, "net", "event"), lambda piece, place: F.when(place == 0, strays(piece))
                                 .when(piece.rlike(r"^<net[\s/>]"), network(piece)).otherwise(one_event(piece))))


# A start tag as feeds write it, with values that need no parser.
_PLAIN_NETWORK = r'^<net id="([A-Za-z0-9_-]+)" name="([A-Za-z0-9_-]+)"/?>$'


def _network(tag, unknown):
    """The attributes of a network's start tag. A parser costs as much for a tag as for half an event."""
    parts = [F.regexp_extract(tag, _PLAIN_NETWORK, n).alias(name) for n, name in enumerate(NETWORK.names, 1)]
    parsed = F.from_xml(F.regexp_replace(tag, r"\s*/?>$", "/>"), NETWORK)
    return F.when(tag.rlike(_PLAIN_NETWORK), F.struct(*parts)).otherwise(F.coalesce(parsed, unknown))


def xml_event_rows(spark: SparkSession, path: str | list[str],
                   event: T.StructType = EVENT, across_files: bool = False,
                   **options) -> DataFrame:
    """One row per ``event`` element, for documents too large to be one record.

    :func:`xml_records` holds a whole document in one string. This reader splits
    at ``</event>`` instead, so that a document or network may be as large as
    the feed, and then hands each event the attributes of the last ``<net>``
    before it. Result: ``network_id``, ``network_name``, ``col`` and
    ``_corrupt_record``, as :func:`feedworks.operators.events.explode_events`
    has them. An event that the end of its file cuts off is corrupt, given as far
    as it was read. ``across_files`` treats the files as one document in the order of
    their names.
    """
    lines = spark.read.options(lineSep=_end_tag("event"), **options).text(path).selectExpr("value", *_PLACE)
    partition_by, block = ([], [FILE, BLOCK]) if across_files else ([FILE], [BLOCK])
    table = event_tokens(lines, event)
    return events_of_tokens(table, carry_forward(table, "_net", [POSITION, "_place"], block, partition_by), event)


#: Where a row of a text file stands, and the size of its file.
_PLACE = [f"_metadata.file_path AS {FILE}", f"_metadata.file_block_start AS {BLOCK}", "_metadata.file_size AS _size"]


def xml_event_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of the text of files arriving in ``path``, cut at ``</event>``, for documents too large
    to be one record; :func:`feedworks.streaming.event_rows_sink` makes events of it.
    Options as for :func:`xml_stream`."""
    options = {"maxFileAge": _ANY_AGE, **options}
    return spark.readStream.options(lineSep=_end_tag("event"), **options).text(path).selectExpr("value", *_PLACE)


def event_tokens(lines: DataFrame, event: T.StructType = EVENT) -> DataFrame:
    """The parsed tokens of text cut at ``</event>``, as they stand in their files; written.
    ``lines`` comes straight from a file reader."""
    ending = _end_tag("event")
    # The first token of a row is empty and counts the row's bytes.
    head = F.struct((F.octet_length("value") + len(ending)).alias("_bytes"), "_size", F.lit(False).alias("_closing"),
                    F.lit(None).cast(_token_type(event)).alias("_token"))
    tokens = bound(_event_tokens(F.concat("value", F.lit(ending)), event), lambda every: F.transform(every, lambda token, at: F.struct(
        F.lit(None).cast("int").alias("_bytes"), F.lit(None).cast("long").alias("_size"),
        ((at == F.size(every) - 1) & token["_net"].isNull()).alias("_closing"), token.alias("_token"))))
    placed = lines.withColumn(POSITION, F.monotonically_increasing_id())
    parsed = placed.select(FILE, BLOCK, POSITION, F.posexplode(F.concat(F.array(head), tokens)).alias("_place", "_row")).select(
        FILE, BLOCK, POSITION, "_place", "_row._bytes", "_row._size", "_row._closing", "_row._token.*")
    return workspace.materialise(parsed, "event-rows")


def events_of_tokens(table: DataFrame, filled: DataFrame, event: T.StructType = EVENT) -> DataFrame:
    """Event rows of the tokens in ``table``; ``filled`` has them with their network in ``_net``,
    dealt by file and block."""
    # The bytes of a file's rows and their ends exceed the file by one end where the last
    # row had none; a mark of the byte order is in the file only.
    over = F.sum("_bytes") - F.max("_size")
    cut_off = (table.where("_bytes IS NOT NULL").groupBy(FILE)
               .agg(over.alias("_over"), F.max(F.struct(BLOCK, POSITION)).alias("_last")).where("_over > 0")
               .select(FILE, F.col(f"_last.{BLOCK}").alias(BLOCK), F.col(f"_last.{POSITION}").alias("_cut_position")))
    # Rows are dealt by block already, so this join moves none of them.
    events = filled.where(F.col("_event").isNotNull()).join(cut_off, [FILE, BLOCK], "left")
    at_end = F.coalesce((F.col("_cut_position") == F.col(POSITION)) & F.col("_closing"), F.lit(False))
    # What follows the last end tag of a file is no event; only its end was put there.
    events = events.where(~(at_end & F.col("_stray")))
    cut = at_end & F.col(f"_event.{CORRUPT}").isNull()
    seen = F.struct(*[F.col(f"_event.{name}").alias(name) for name in event.names])
    as_read = F.regexp_replace(F.to_xml(F.when(cut, seen), {"rowTag": "event"}), r"\s*(</event>|/>)\s*$", "")
    return events.select(
        F.col("_net._id").alias("network_id"),
        F.col("_net._name").alias("network_name"),
        F.struct(*[F.when(~cut, F.col(f"_event.{name}")).alias(name) for name in event.names]).alias("col"),
        F.when(cut, as_read).otherwise(F.col(f"_event.{CORRUPT}")).alias(CORRUPT),
    )


def _token_type(event: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("_net", NETWORK), T.StructField("_stray", T.BooleanType()),
                         T.StructField("_event", with_corrupt(event))])

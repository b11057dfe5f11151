"""The registered queries as SQL over the test tables."""

from __future__ import annotations

from feedworks.schema import MESSAGE_COLUMNS

_K = "json_extract_string(props, '$.k')"

_RECORD = {
    "doc_id": "sha1(CAST(event_id AS VARCHAR))",
    "network_id": "CAST(user_id AS VARCHAR)",
    "network_name": "'user-' || user_id",
    "update_timestamp": "ts",
    "event_id": "CAST(event_id AS VARCHAR)",
    "severity": "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)",
    "update_type": "event_type",
    "location_id": _K,
    "location_lat": "value",
    "location_long": "0 - value / 2",
    "status": "CASE event_type WHEN 'error' THEN 'closed' ELSE 'open' END",
    "source": "'net-' || user_id",
    "contact": "CASE WHEN event_type <> 'view' THEN 'ops & <' || user_id || '>' END",
    "message_codes_code1": f"CASE WHEN event_type <> 'signup' THEN 'M' || {_K} END",
    "message_codes_code4": f"CASE WHEN event_type <> 'signup' THEN 'M' || {_K} END",
    "affected_lanes_lane": "CAST(user_id % 4 AS VARCHAR)",
    "affected_lanes_lane_status": "'lane ' || event_type",
    "type": "event_type",
    "type_description": "'Événement ' || event_type",
    "road_conditions": "CASE WHEN value < 10 THEN 'dry' ELSE 'wet' END",
    "weather_conditions": "CASE WHEN value < 5 THEN 'clear' ELSE 'rain' END",
    "start_timestamp": "ts - INTERVAL 1 HOUR",
    "atis_severity": f"CASE WHEN event_type <> 'purchase' THEN {_K} END",
    "atis_timestamp": "CASE WHEN event_type <> 'purchase' THEN ts END",
}


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"


_EVENTS_21 = _select(_RECORD, "events")
_EVENTS_20 = _select({n: e for n, e in _RECORD.items() if n != "doc_id"}, "events")

# The raw record has the names of the feed.
_RAW = _select({
    "network_id": _RECORD["network_id"], "network_name": _RECORD["network_name"],
    "col__id": _RECORD["event_id"], "col_updateTimestamp": "ts",
    "col_severity": _RECORD["severity"], "col_updateType": "event_type",
    "col_primaryLoc_locationId": _K, "col_primaryLoc_lat": "value",
    "col_primaryLoc_lon": "0 - value / 2", "col_status": _RECORD["status"],
    "col_source": _RECORD["source"], "col_contact": _RECORD["contact"],
    "col_messageCodes_code1": _RECORD["message_codes_code1"],
    "col_affectedLanes__lane1": _RECORD["affected_lanes_lane"],
    "col_affectedLanes__VALUE": _RECORD["affected_lanes_lane_status"],
    "col_type__VALUE": "event_type", "col_typeDesc": _RECORD["type_description"],
    "col_roadCond__VALUE": _RECORD["road_conditions"],
    "col_weatherCond__VALUE": _RECORD["weather_conditions"],
    "col_startTimestamp": _RECORD["start_timestamp"],
    "col_atisSeverity_severity": _RECORD["atis_severity"],
    "col_atisSeverity_timestamp": _RECORD["atis_timestamp"],
}, "events")

_CORRUPT_SPLIT = """
    SELECT CASE WHEN event_type <> 'view' THEN 'quarantined' ELSE 'good' END AS outcome,
           CAST(event_id AS VARCHAR) AS event_id,
           CASE WHEN event_type = 'view' THEN event_type END AS update_type
    FROM events"""

# Damaged record tags, and an end after the network, leave the events whole.
_CORRUPT_EVENTS = """
    SELECT CASE WHEN event_type IN ('error', 'purchase') OR event_type = 'click' AND event_id % 2 = 0
                THEN 'quarantined' ELSE 'good' END AS outcome,
           CAST(event_id AS VARCHAR) AS event_id
    FROM events"""

_EVENT_IDS = "SELECT CAST(event_id AS VARCHAR) AS event_id FROM events"

_REPLACE_COMPACTED = """
    WITH arrived AS (
        SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN value END AS value),
               CAST(event_type = 'error' AS INTEGER) AS batch FROM events),
    newest AS (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY batch DESC, ts DESC, event_id DESC) AS n FROM arrived)
    SELECT user_id, event_id, ts, event_type, value, props FROM newest WHERE n = 1"""

_SUPPLIER_STRINGS = _select(
    {c: f"CAST({c} AS VARCHAR)" for c in ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]}, "supplier")

_JSON_LINES = """
    SELECT 6 AS n_keys, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority FROM orders"""

_RENAME = """
    SELECT s_suppkey AS event_id, s_name AS network_name, s_nationkey AS network_id,
           s_acctbal AS severity FROM supplier"""


def _segments(rows: str, order: str, columns: str, partition_by: str = "") -> str:
    """Rows with ``closes`` and ``kept`` to one row per closing row."""
    by = f"PARTITION BY {partition_by}" if partition_by else ""
    group = f"{partition_by}, segment" if partition_by else "segment"
    return f"""
    WITH source AS ({rows}),
    numbered AS (
        SELECT *, coalesce(sum(CAST(closes AS INTEGER)) OVER ({by} ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS segment FROM source)
    SELECT {columns} FROM numbered GROUP BY {group} HAVING bool_or(closes)"""


def _joined(value: str, order: str) -> str:
    return f"coalesce(string_agg({value}, '~~' ORDER BY {order}) FILTER (kept AND NOT closes), '')"


_CONVERSATIONS = _segments(
    "SELECT *, role = 'assistant' AS closes, text IS NOT NULL AS kept FROM conversations", "turn",
    f"conv_id, max(text) FILTER (closes) AS answer, {_joined('text', 'turn')} AS before", "conv_id")

_ORDER_RANGES = _segments(
    "SELECT *, role = 'assistant' AND turn > 2 AS closes, role = 'user' AS kept FROM conversations",
    "conv_id, turn",
    f"max(conv_id) FILTER (closes) AS conv_id, {_joined('CAST(turn AS VARCHAR)', 'conv_id, turn')} AS turns")

_FILE_ORDER = _segments(
    r"""SELECT *, regexp_matches(line, '[1-9]\.|10\.|[IV]\.') AS kept FROM (
            SELECT conv_id, turn, role = 'assistant' AS closes,
                   turn || '. ' || regexp_replace(text, '[\t\r\n]+', ' ', 'g') AS line
            FROM conversations)""",
    "conv_id, turn",
    f'max(line) FILTER (closes) AS "Accessno", {_joined("line", "conv_id, turn")} AS "Subjects"')

_SUBJECT_LINES = r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[1-9]\.|10\.|[IV]\.')"

_ARRIVED = """
    WITH arrived AS (
        SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN value END AS value),
               list_position(['view', 'error', 'signup', 'click', 'purchase'], event_type) AS batch
        FROM events"""

_LATE_ERRORS = """
        UNION ALL
        SELECT * REPLACE (CAST(NULL AS DOUBLE) AS value), 6 AS batch FROM events
        WHERE event_type = 'error'"""

_NEWEST = """),
    newest AS (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY batch DESC, ts DESC, event_id DESC) AS n FROM arrived)"""

_REPLACE = _ARRIVED + _NEWEST + """
    SELECT user_id, event_id, ts, event_type, value, props FROM newest WHERE n = 1"""

_MERGE = _ARRIVED + _LATE_ERRORS + _NEWEST + """,
    valued AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id
               ORDER BY batch DESC, ts DESC, event_id DESC) AS n FROM arrived WHERE value IS NOT NULL)
    SELECT newest.user_id, event_id, ts, event_type, valued.value AS value, props
    FROM newest LEFT JOIN valued ON newest.user_id = valued.user_id AND valued.n = 1
    WHERE newest.n = 1"""

_PARTS = """
    SELECT event_id, p_partkey, p_brand, p_type FROM (
        SELECT p_name AS event_id, p_partkey, p_brand, p_type,
               row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS n FROM part)
    WHERE n = 1"""

_MESSAGE_FIELDS = {
    "EVENT_RECORD_ID": "CAST(o_orderkey AS VARCHAR)",
    "EVENT_ID": "'E' || o_orderkey",
    "NETWORK_ID": "CAST(o_custkey AS VARCHAR)",
    "EVENT_CATEGORY_ID": "o_orderstatus",
    "EVENT_SEVERITY_ID": "substring(o_orderpriority, 1, 1)",
    "UPDATE_TIME": "strftime(o_orderdate, '%Y-%m-%d')",
    "PRI_LOCATION_RECORD": "'R' || o_orderkey",
    "EVENT_STATUS_ID": "o_orderstatus",
    "EVENT_DESC": "'priority ' || o_orderpriority || ', ' || strftime(o_orderdate, '%Y-%m-%d')",
}


def _messages(second_location: str, corrupt: str = "CAST(NULL AS VARCHAR)", **changed: str) -> str:
    fields = {**_MESSAGE_FIELDS, **changed}
    columns = {c: fields.get(c, "'p'" if c.startswith("PRI") else second_location) for c in MESSAGE_COLUMNS}
    return _select({**columns, "_corrupt_record": corrupt}, "orders")


# The message as it is written: empty fields for missing ones, the description quoted.
_MESSAGE_TEXT = " || ',' || ".join(
    f"'\"' || {_MESSAGE_FIELDS[c]} || '\"'" if c == "EVENT_DESC"
    else _MESSAGE_FIELDS.get(c, "'p'" if c.startswith("PRI") else "''") for c in MESSAGE_COLUMNS)

_OVERFLOW = """
    SELECT 'E' || o_orderkey AS event_id, CASE WHEN o_orderkey % 3 = 0 THEN 'set aside' ELSE 'good' END AS outcome,
           CASE WHEN o_orderkey % 3 = 0 THEN 'one,two' END AS beyond FROM orders"""

ORACLE_SQL = {
    "xml_events_21": _EVENTS_21,
    "xml_events_20": _EVENTS_20,
    "xml_events_raw": _RAW,
    "xml_wrapped_files": _EVENTS_21,
    "xml_whole_files": _EVENTS_20,
    "xml_column_parse": _EVENTS_21,
    "xml_corrupt_split": _CORRUPT_SPLIT,
    "xml_corrupt_events": _CORRUPT_EVENTS,
    "xml_large_document": _EVENTS_21,
    "stream_large_document": _EVENTS_21,
    "stream_segments": _CONVERSATIONS,
    "upsert_replayed": """SELECT * FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "table_new_columns": """SELECT event_id, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
      CASE WHEN event_type = 'click' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value,
      CASE WHEN event_type = 'click' THEN event_type END AS event_type FROM events""",
    "raw_archive_roundtrip": _EVENTS_21,
    "json_roundtrip": _EVENTS_21,
    "csv_flat_roundtrip": _EVENTS_21,
    "csv_strings": _SUPPLIER_STRINGS,
    "json_lines": _JSON_LINES,
    "positional_rename": _RENAME,
    "segments_conversations": _CONVERSATIONS,
    "segments_order_ranges": _ORDER_RANGES,
    "segments_file_order": _FILE_ORDER,
    "subject_lines": _SUBJECT_LINES,
    "table_create_append": _EVENTS_20,
    "files_by_number": "SELECT 3 AS n_files, count(*) AS n_rows FROM part",
    "upsert_replace": _REPLACE,
    "upsert_replace_compacted": _REPLACE_COMPACTED,
    "upsert_new_column": "SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN value END AS value FROM events",
    "upsert_merge": _MERGE,
    "upsert_compacted": _MERGE,
    "upsert_from_csv": _PARTS,
    "stream_xml_json": _EVENTS_21,
    "stream_xml_quarantine": f"SELECT outcome, event_id FROM ({_CORRUPT_SPLIT})",
    "stream_row_counts": "SELECT count(*) AS n_rows FROM events",
    "stream_skip_empty": _EVENT_IDS,
    "stream_interval": _EVENT_IDS,
    "stream_xml_table": _EVENTS_20,
    "stream_files_packed": "SELECT * FROM events",
    "stream_table_packed": "SELECT * FROM events",
    "stream_xml_upsert": _EVENTS_20,
    "stream_messages_ids": _select(
        {"network_id": _MESSAGE_FIELDS["NETWORK_ID"], "event_id": _MESSAGE_FIELDS["EVENT_ID"]}, "orders"),
    "messages_decode_26": _messages("CAST(NULL AS VARCHAR)"),
    # Without quoting the description is cut at its comma, and the message, having a
    # field too many, is kept as a whole.
    "messages_decode_plain": _messages("''", _MESSAGE_TEXT, EVENT_DESC="'\"priority ' || o_orderpriority"),
    "messages_overflow": _OVERFLOW,
    "preview_top_n": _EVENTS_21 + " ORDER BY ts DESC, CAST(event_id AS VARCHAR) LIMIT 10",
}

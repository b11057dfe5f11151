"""Schemas and field maps of the feeds.

XML leaves are parsed as strings and cast when they are projected: with a typed
``from_xml`` schema a single bad number would null every field of its record.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Element names of the traffic-event feed. Attributes carry the
# prefix "_", text beside attributes is "_VALUE".
ROW_TAG = "eventData"
EVENT_ELEMENTS = {
    "_id": str,
    "updateTimestamp": str,
    "severity": str,
    "updateType": str,
    "primaryLoc": {"locationId": str, "lat": str, "lon": str},
    "status": str,
    "source": str,
    "contact": str,
    "messageCodes": {"code1": str},
    "affectedLanes": {"_lane1": str, "_VALUE": str},
    "type": {"_VALUE": str},
    "typeDesc": str,
    "roadCond": {"_VALUE": str},
    "weatherCond": {"_VALUE": str},
    "startTimestamp": str,
    "atisSeverity": {"severity": str, "timestamp": str},
}

# Names of the 20 output columns and the feed paths they come
# from. A tuple is (path, type); a dict becomes a struct of such fields. code4
# repeats code1 on purpose, as consumers of the record have always received it.
EVENT_FIELDS = {
    "update_timestamp": ("updateTimestamp", "timestamp_ntz"),
    "event_id": ("_id", "string"),
    "severity": ("severity", "string"),
    "update_type": ("updateType", "string"),
    "location_id": ("primaryLoc.locationId", "string"),
    "location": {
        "lat": ("primaryLoc.lat", "double"),
        "long": ("primaryLoc.lon", "double"),
    },
    "status": ("status", "string"),
    "source": ("source", "string"),
    "contact": ("contact", "string"),
    "message_codes": {
        "code1": ("messageCodes.code1", "string"),
        "code4": ("messageCodes.code1", "string"),
    },
    "affected_lanes": {
        "lane": ("affectedLanes._lane1", "string"),
        "lane_status": ("affectedLanes._VALUE", "string"),
    },
    "type": ("type._VALUE", "string"),
    "type_description": ("typeDesc", "string"),
    "road_conditions": ("roadCond._VALUE", "string"),
    "weather_conditions": ("weatherCond._VALUE", "string"),
    "start_timestamp": ("startTimestamp", "timestamp_ntz"),
    "atis_severity": ("atisSeverity.severity", "string"),
    "atis_timestamp": ("atisSeverity.timestamp", "timestamp_ntz"),
}

# The 26 columns of a comma-separated message, in message order.
MESSAGE_COLUMNS = [
    "EVENT_RECORD_ID", "EVENT_ID", "NETWORK_ID", "EVENT_CATEGORY_ID",
    "EVENT_SEVERITY_ID", "UPDATE_TIME",
    "PRI_LOCATION_RECORD", "PRI_LOCATION_LATITUDE", "PRI_LOCATION_LONGITUDE",
    "PRI_LOCATION_ROAD", "PRI_LOCATION_DIRECTION", "PRI_LOCATION_OFFSET",
    "PRI_LOCATION_CROSS", "PRI_LOCATION_CITY", "PRI_LOCATION_COUNTY",
    "SEC_LOCATION_RECORD", "SEC_LOCATION_LATITUDE", "SEC_LOCATION_LONGITUDE",
    "SEC_LOCATION_ROAD", "SEC_LOCATION_DIRECTION", "SEC_LOCATION_OFFSET",
    "SEC_LOCATION_CROSS", "SEC_LOCATION_CITY", "SEC_LOCATION_COUNTY",
    "EVENT_STATUS_ID", "EVENT_DESC",
]

# The catalogue export's closing tag, list separator, the pattern
# of a subject line and the output column names. The pattern looks anywhere in a
# line, so that two-digit numbers but 10 and Roman numerals but I and V need no alternatives of
# their own (their ends match), and fewer are tried per row.
ACCESSION_TAG = "Accn Nos"
SUBJECT_SEPARATOR = "~~"
SUBJECT_PATTERN = r"[1-9]\.|10\.|[IV]\."
SUBJECT_COLUMNS = ("Accessno", "Subjects")


def string_fields(names) -> T.StructType:
    """A schema of strings; in a mapping, a mapping as value gives a struct."""
    nested = names if isinstance(names, dict) else {}
    return T.StructType([
        T.StructField(n, string_fields(nested[n]) if isinstance(nested.get(n), dict) else T.StringType())
        for n in names])


NETWORK = string_fields(["_id", "_name"])
EVENT = string_fields(EVENT_ELEMENTS)
MESSAGE = string_fields(MESSAGE_COLUMNS)

#: One row of the feed. ``net`` and ``event`` are always arrays, so a record
#: with a single one of either has the same shape as any other.
EVENT_RECORD = T.StructType([
    T.StructField("net", T.ArrayType(
        T.StructType([*NETWORK, T.StructField("event", T.ArrayType(EVENT))]))),
])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that takes text that does not parse."""
    if CORRUPT in schema.names:
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])

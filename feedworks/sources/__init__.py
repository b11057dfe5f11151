from feedworks.sources.delimited import delimited
from feedworks.sources.jdbc import balanced_predicates, jdbc_balanced, jdbc_options, jdbc_table
from feedworks.sources.kafka import as_messages, kafka_messages, kafka_options
from feedworks.sources.xml import (
    parse_xml_column,
    quarantined,
    well_formed,
    xml_event_rows,
    xml_event_stream,
    xml_records,
    xml_stream,
)

__all__ = [
    "as_messages", "balanced_predicates", "delimited", "jdbc_balanced", "jdbc_options", "jdbc_table", "kafka_messages",
    "kafka_options", "parse_xml_column", "quarantined", "well_formed",
    "xml_event_rows", "xml_event_stream", "xml_records", "xml_stream",
]

"""Random records written as XML are read back as they were."""

import random

import pytest
from pyspark.sql import functions as F

from feedworks.operators.events import explode_events
from feedworks.schema import CORRUPT, EVENT_RECORD, ROW_TAG
from feedworks.sources import parse_xml_column, xml_event_rows, xml_records

PIECES = ["a", "Z", "9", " ", "é", "漢", "😀", "&", "<", ">", '"', "'", "/>", "</", "]]>", "<!--", "--",
          "eventData", "</event", "<net ", "=", "&amp;", "\\", "%", "\t"]


def random_text(rng):
    """Some text with something in it besides blanks, or nothing."""
    if rng.random() < 0.3:
        return None
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(6))) + rng.choice("xyz")


def random_struct(rng, schema):
    values = []
    for field in schema:
        if field.dataType.typeName() == "struct":
            inner = random_struct(rng, field.dataType)
            values.append(inner if any(v is not None for v in inner) else None)
        else:
            text = random_text(rng)
            # A tab in an attribute is a blank in XML.
            values.append(text.replace("\t", " ") if text and field.name.startswith("_") else text)
    return tuple(values)


@pytest.fixture(scope="module")
def records():
    rng = random.Random(11)
    net = EVENT_RECORD["net"].dataType.elementType
    event = net["event"].dataType.elementType
    out = []
    for r in range(40):
        nets = []
        for n in range(rng.randrange(1, 4)):
            events = [(f"{r}.{n}.{e}", *random_struct(rng, event.fields[1:])) for e in range(rng.randrange(1, 4))]
            nets.append((f"{r}.{n}", f"n>{n}/>'\"", events))
        out.append((nets,))
    return out


def rows(events):
    columns = ["network_id", "network_name", "col"]
    return sorted(events.select(*columns).collect(), key=lambda r: r.col._id)


def test_round_trip(spark, tmp_path, small_splits, records):
    df = spark.createDataFrame(records, EVENT_RECORD)
    expected = rows(explode_events(df))
    xml = df.select(F.to_xml(F.struct("net"), {"rowTag": ROW_TAG}).alias("value"))
    xml.coalesce(2).write.text(str(tmp_path / "x"))

    back = xml_records(spark, str(tmp_path / "x"))
    assert back.where(F.col(CORRUPT).isNotNull()).count() == 0
    assert rows(explode_events(back)) == expected
    assert rows(explode_events(parse_xml_column(xml, "value"))) == expected
    small_splits(4000)
    assert rows(explode_events(xml_records(spark, str(tmp_path / "x")))) == expected
    large = xml_event_rows(spark, str(tmp_path / "x"))
    assert large.where(F.col(CORRUPT).isNotNull()).count() == 0
    assert rows(large) == expected

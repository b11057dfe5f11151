import pytest
from pyspark.sql import functions as F

from feedworks.operators.events import event_records, explode_events, flatten
from feedworks.schema import CORRUPT
from feedworks.sources import (
    parse_xml_column, quarantined, well_formed, xml_event_rows, xml_records, xml_stream,
)


def event(i, extra=""):
    return f'<event id="{i}"><severity>{i}</severity>{extra}</event>'


def record(*events, net="1"):
    return f'<eventData><net id="{net}" name="n{net}">{"".join(events)}</net></eventData>'


def write(folder, text, name="feed.xml"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def ids(df):
    return sorted(r.event_id for r in event_records(df).select("event_id").collect())


def test_nets_and_events(spark, tmp_path):
    text = ('<eventData><net id="1" name="a">' + event(1) + event(2) + '</net>'
            '<net id="2" name="b">' + event(3) + '</net><net id="3" name="c"/></eventData>')
    rows = event_records(xml_records(spark, write(tmp_path / "x", text))).collect()
    assert [(r.network_id, r.network_name, r.event_id) for r in rows] == [
        ("1", "a", "1"), ("1", "a", "2"), ("2", "b", "3")]


def test_one_event_and_leading_zeros(spark, tmp_path):
    path = write(tmp_path / "x", record(event("001")))
    row = event_records(xml_records(spark, path)).first()
    assert row.event_id == "001"
    assert row.doc_id == "e193a01ecf8d30ad0affefd332ce934e32ffce72"


def test_missing_fields(spark, tmp_path):
    path = write(tmp_path / "x", record("<event><source>s</source></event>"))
    row = event_records(xml_records(spark, path)).first().asDict(recursive=True)
    assert row["event_id"] is None and row["doc_id"] is None and row["source"] == "s"
    assert row["location"] == {"lat": None, "long": None}
    assert row["message_codes"] == {"code1": None, "code4": None}
    assert row["affected_lanes"] == {"lane": None, "lane_status": None}


def test_all_21_columns(spark, tmp_path):
    full = event(7, """
        <updateTimestamp>2018-01-02T03:04:05.123456</updateTimestamp>
        <updateType>update</updateType>
        <primaryLoc><locationId>L1</locationId><lat>40.5</lat><lon>-73.25</lon></primaryLoc>
        <secondaryLoc><lat>1</lat></secondaryLoc><category>x</category>
        <status>open</status><source>S</source><contact>A &amp; B é</contact>
        <messageCodes><code1>m1</code1></messageCodes>
        <affectedLanes lane1="2">closed</affectedLanes>
        <type code="9">crash</type><typeDesc>a crash</typeDesc>
        <roadCond id="1">wet</roadCond><weatherCond>rain</weatherCond>
        <startTimestamp>2018-01-02T03:00:00</startTimestamp>
        <atisSeverity><severity>3</severity><timestamp>2018-01-02T03:01:00</timestamp></atisSeverity>""")
    path = write(tmp_path / "x", record(full).replace("<eventData>", '<eventData xmlns="http://x/y">'))
    df = event_records(xml_records(spark, path))
    assert len(df.columns) == 21
    row = df.select(*[F.col(c).cast("string") for c in df.columns]).first().asDict()
    assert row == {
        "doc_id": "902ba3cda1883801594b6e1b452790cc53948fda", "network_id": "1",
        "network_name": "n1", "update_timestamp": "2018-01-02 03:04:05.123456",
        "event_id": "7", "severity": "7", "update_type": "update", "location_id": "L1",
        "location": "{40.5, -73.25}", "status": "open", "source": "S", "contact": "A & B é",
        "message_codes": "{m1, m1}", "affected_lanes": "{2, closed}", "type": "crash",
        "type_description": "a crash", "road_conditions": "wet", "weather_conditions": "rain",
        "start_timestamp": "2018-01-02 03:00:00", "atis_severity": "3",
        "atis_timestamp": "2018-01-02 03:01:00"}
    assert flatten(explode_events(xml_records(spark, path)), doc_id=False).columns == df.columns[1:]


def test_code4_from_another_source(spark, tmp_path):
    path = write(tmp_path / "x", record(event(1)))
    events = explode_events(xml_records(spark, path))
    fields = {"message_codes": {"code1": "messageCodes.code1", "code4": "severity"}}
    assert flatten(events, fields=fields).first().message_codes.code4 == "1"


def test_bad_number_nulls_only_itself(spark, tmp_path):
    bad = event(1, "<primaryLoc><lat>abc</lat><lon>2</lon></primaryLoc>")
    row = event_records(xml_records(spark, write(tmp_path / "x", record(bad)))).first()
    assert (row.event_id, row.location.lat, row.location.long) == ("1", None, 2.0)


@pytest.mark.parametrize("wrapped", [True, False])
def test_splits(spark, tmp_path, small_splits, wrapped):
    text = "\n".join(record(event(2 * i), "\n  " + event(2 * i + 1)) for i in range(200))
    if wrapped:
        text = f'<?xml version="1.0"?>\n<feed>\n{text}\n</feed>\n'
    path = write(tmp_path / "x", text)
    whole = ids(xml_records(spark, path))
    small_splits(500)
    df = xml_records(spark, path)
    assert df.rdd.getNumPartitions() > 20
    assert ids(df) == whole and len(whole) == 400
    assert df.where(F.col(CORRUPT).isNotNull()).count() == 0


def test_broken_records_are_set_aside(spark, tmp_path, small_splits):
    small_splits(300)
    parts = [record(event(i)) for i in range(50)]
    parts[10] = '<eventData><net id="1"><event id="10"></net></eventData>'
    parts[20] = '<eventData><net id="1"><event id="20">'
    parts[30] = '<eventData/>'
    parts[31] = '<eventData a="x>y" />'
    parts.append('<eventData><net id="1"><event id="99">')
    df = xml_records(spark, write(tmp_path / "x", "\n".join(parts)))
    assert set(map(int, ids(df))) == set(range(50)) - {10, 20, 30, 31}
    bad = [r[0] for r in quarantined(df).collect()]
    assert len(bad) == 3 and all(any(f'id="{i}"' in b for b in bad) for i in (10, 20, 99))
    assert well_formed(df).count() == 46


def test_records_in_a_column(spark):
    df = spark.createDataFrame([
        (1, record(event(1))), (2, f"<wrap>{record(event(2))}</wrap>"),
        (3, record(event(3)) + record(event(4))), (4, "<eventData><net>"), (5, None), (6, "")],
        "k int, text string")
    out = parse_xml_column(df, "text", keep=("k",))
    got = [(r.k, r.n, r.bad) for r in out.select(
        "k", F.col("net")[0].event[0]._id.alias("n"), F.col(CORRUPT).isNotNull().alias("bad")).collect()]
    assert sorted(got, key=str) == [(1, "1", False), (2, "2", False), (3, "3", False),
                                    (3, "4", False), (4, None, True)]


def test_whole_file_reader_agrees(spark, tmp_path):
    path = write(tmp_path / "x", f"<feed>{record(event(1), event(2))}{record(event(3))}</feed>")
    assert ids(xml_records(spark, path, whole_files=True)) == ids(xml_records(spark, path))


def test_surrounding_blanks_belong_to_text(spark, tmp_path):
    path = write(tmp_path / "x", record("\n <event id='1'>\n <contact> a </contact>\n</event>\n"))
    assert event_records(xml_records(spark, path)).first().contact == " a "


def test_record_is_parsed_once(spark, tmp_path):
    df = event_records(xml_records(spark, write(tmp_path / "x", record(event(1)))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") == 1


def test_stream_reads_both_files_of_a_batch(spark, tmp_path):
    write(tmp_path / "x", record(event(1)), "a.xml")
    path = write(tmp_path / "x", record(event(2)), "b.xml")
    query = (event_records(xml_stream(spark, path)).writeStream.format("memory").queryName("both")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination(60)
    assert sorted(r.event_id for r in spark.table("both").collect()) == ["1", "2"]


def big_document(nets=6, events=40):
    text, expected, i = ["<?xml version='1.0'?><eventData>\n"], [], 0
    for n in range(nets):
        text.append(f'<net id="{n}" name="n &amp; {n}">\n')
        for _ in range(events if n != 2 else 0):
            text.append(event(i, f"<typeDesc>net {n}</typeDesc>\n"))
            expected.append((str(n), f"n & {n}", str(i)))
            i += 1
        text.append("</net>\n" if n != 3 else "</net><net id='e'/>\n")
    return "".join(text) + "</eventData>\n", expected


def event_rows(df):
    return sorted((r.network_id, r.network_name, r.event_id) for r in df.select(
        "network_id", "network_name", "col._id").toDF("network_id", "network_name", "event_id").collect())


def test_events_of_one_large_document(spark, tmp_path, small_splits):
    small_splits(1500)
    text, expected = big_document()
    df = xml_event_rows(spark, write(tmp_path / "x", text))
    assert event_rows(df) == sorted(expected)
    assert df.where(F.col(CORRUPT).isNotNull()).count() == 0
    flat = flatten(df)
    assert len(flat.columns) == 21
    assert {(r.network_id, r.type_description) for r in flat.collect()} == {
        (str(n), f"net {n}") for n in (0, 1, 3, 4, 5)}


def test_event_rows_across_files(spark, tmp_path, small_splits):
    text, expected = big_document()
    cut = text.index('<event id="50"')
    write(tmp_path / "x", text[:cut], "part-0")
    path = write(tmp_path / "x", text[cut:], "part-1")
    small_splits(1500)
    assert event_rows(xml_event_rows(spark, path, across_files=True)) == sorted(expected)
    alone = xml_event_rows(spark, path)
    assert alone.count() == len(expected)
    assert alone.where("network_id is null").count() == 30


def test_broken_event_rows(spark, tmp_path):
    text = ('<eventData><net id="1" name="a">' + event(1) + '<event id="2"><severity></event>'
            + '<event id="3"/>' + '<event id="4"><severity>' + event(5)
            + '</net><net id="2" name=' + event(6) + '<net id="3" name="c">' + event(7))
    df = xml_event_rows(spark, write(tmp_path / "x", text))
    got = {(r.network_id, r.col._id) for r in df.where(F.col(CORRUPT).isNull()).collect()}
    assert got == {("1", "1"), ("1", "3"), ("1", "5"), (None, "6"), ("3", "7")}
    bad = [r[0] for r in quarantined(df).collect()]
    assert len(bad) == 3 and any('id="2"><severity>' in b for b in bad)
    assert any('id="4"' in b for b in bad) and any("<net" in b for b in bad)


def test_end_tags_with_blanks(spark, tmp_path):
    """Such a file is not split, but read."""
    text = f"<feed>{record(event(1))}\n{record(event(2))}</feed>".replace("</eventData>", "</eventData\n>")
    df = xml_records(spark, write(tmp_path / "x", text + "<!-- end -->"))
    assert ids(df) == ["1", "2"] and quarantined(df).count() == 0


def test_longer_tag_names_are_other_elements(spark, tmp_path):
    text = record(event(1)).replace("<net", "<eventDataInfo>x</eventDataInfo><net")
    assert ids(xml_records(spark, write(tmp_path / "x", text + "<eventDatabase/>"))) == ["1"]


def test_times_in_another_form(spark, tmp_path):
    path = write(tmp_path / "x", record(event(1, "<startTimestamp>01/02/18 3 PM</startTimestamp>")))
    events = explode_events(xml_records(spark, path))
    assert flatten(events).first().start_timestamp is None
    assert flatten(events, typed=False).first().start_timestamp == "01/02/18 3 PM"


def corrupt_of(df):
    return [r[0] for r in quarantined(df).collect()]


def test_a_cut_off_end_is_no_good_record(spark, tmp_path):
    inner = '<event id="1"><severity>1</severity></event><event id="2"><severity>2</severity>'
    path = write(tmp_path / "child", f'<eventData><net id="1">{inner}')
    assert ids(xml_records(spark, path)) == [] and len(corrupt_of(xml_records(spark, path))) == 1
    rows = xml_event_rows(spark, path)
    assert [r.col._id for r in rows.where(F.col(CORRUPT).isNull()).collect()] == ["1"]
    (text,) = corrupt_of(rows)
    assert text.startswith('<event id="2">') and "<severity>2</severity>" in text
    path = write(tmp_path / "net", record(event(1)) + "\n" + record(event(2)).replace("</eventData>", ""))
    assert ids(xml_records(spark, path)) == ["1"] and len(corrupt_of(xml_records(spark, path))) == 1
    # Its events are whole.
    assert event_rows(xml_event_rows(spark, path))[-1][2] == "2" and not corrupt_of(xml_event_rows(spark, path))


def test_damaged_start_tags_are_kept(spark, tmp_path):
    text = (record(event(1)) + record(event(2)).replace("<eventData>", "<evntData>") + record(event(3))
            + record('<evnt id="4"></event>' + event(5)) + record(event(6)))
    records = xml_records(spark, write(tmp_path / "x", text))
    assert ids(records) == ["1", "3", "6"]
    bad = corrupt_of(records)
    assert len(bad) == 2 and any("evntData" in b and 'id="2"' in b for b in bad) and any('evnt id="4"' in b for b in bad)
    rows = xml_event_rows(spark, write(tmp_path / "x", text))
    assert sorted(r[2] for r in event_rows(rows.where(F.col(CORRUPT).isNull()))) == ["1", "2", "3", "5", "6"]
    assert corrupt_of(rows) == ['<evnt id="4"></event>']


def test_both_halves_of_a_record_with_an_end_tag_in_a_comment(spark, tmp_path):
    text = record("<!-- </eventData> -->" + event(1)) + record(event(2))
    path = write(tmp_path / "x", text)
    assert ids(xml_records(spark, path)) == ["2"]
    assert any('id="1"' in b for b in corrupt_of(xml_records(spark, path)))
    assert ids(xml_records(spark, path, whole_files=True)) == ["1", "2"]


def test_whole_files_go_on_after_a_broken_record(spark, tmp_path):
    broken = record(event(2)).replace("</net>", "")
    path = write(tmp_path / "x", record(event(1)) + broken + record(event(3)) + record(event(4)))
    records = xml_records(spark, path, whole_files=True)
    assert ids(records) == ["1", "3", "4"] and corrupt_of(records) == [broken]


def test_carry_over_files_has_no_window_over_all_blocks(spark, tmp_path, small_splits):
    text, expected = big_document()
    cut = text.index('<event id="50"')
    write(tmp_path / "x", text[:cut], "part-0")
    path = write(tmp_path / "x", text[cut:], "part-1")
    small_splits(1500)
    df = xml_event_rows(spark, path, across_files=True)
    assert event_rows(df) == sorted(expected)
    plan = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if " Window " in line]
    # Within files by file, and among files over one row each.
    assert sum("_file" in line.split("windowspecdefinition")[1].split(" ASC")[0] for line in windows) >= 1

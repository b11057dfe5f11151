import pytest

from feedworks.__main__ import main, parser
from feedworks.plans import jobs
from feedworks.sinks import current_state

FEED = ('<eventData><net id="7" name="n"><event id="1"><status>open</status></event>'
        '<event id="2"/></net></eventData>\n<eventData><net id=broken></eventData>')


@pytest.fixture
def feed(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(FEED)
    return str(tmp_path / "in")


def test_xml_to_json(spark, tmp_path, feed):
    for _ in range(2):
        main(["xml-to-json", feed, str(tmp_path / "archive"), str(tmp_path / "out")])
    assert sorted(r.event_id for r in spark.read.json(str(tmp_path / "out")).collect()) == ["1", "2"]
    archive = spark.read.parquet(str(tmp_path / "archive"))
    assert archive.count() == 4 and archive.where("_corrupt_record is not null").count() == 2


def test_xml_to_csv(spark, tmp_path, feed):
    for _ in range(2):
        main(["xml-to-csv", feed, str(tmp_path / "out")])
    rows = spark.read.csv(str(tmp_path / "out"))
    assert rows.count() == 4 and len(rows.columns) == 24


def test_xml_to_table(spark, feed):
    main(["xml-to-table", feed, "--table", "raw_events"])
    main(["xml-to-table", feed, "--table", "raw_events"])
    table = spark.table("raw_events")
    assert table.columns == ["network_id", "network_name", "col"] and table.count() == 4
    main(["xml-to-table", feed, "--table", "flat_events", "--flat"])
    assert len(spark.table("flat_events").columns) == 20
    main(["xml-to-table", feed, "--table", "flat_events", "--flat", "--large-documents"])
    assert spark.table("flat_events").dropDuplicates().count() == 2
    assert spark.table("flat_events").count() == 4
    with pytest.raises(ValueError):
        jobs.xml_to_table(spark, feed, "flat_events", raw=True)


def test_csv_to_upsert(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_id,x\n1,a\n2,b\n")
    (tmp_path / "b.csv").write_text("event_id,x\n2,c\n")
    for name in "ab":
        main(["csv-to-upsert", str(tmp_path / f"{name}.csv"), "from_csv"])
    state = current_state(spark, "from_csv", "event_id")
    assert sorted(tuple(r) for r in state.collect()) == [("1", "a"), ("2", "c")]


def test_catalogue_to_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("t\tx\nSubject\t1. a\nSubject\t2. b\nAccn Nos\tA9\n")
    main(["catalogue-to-csv", str(tmp_path / "d.csv"), str(tmp_path / "out")])
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["A9^1. a~~2. b"]


def test_xml_stream(spark, tmp_path, feed):
    common = ["xml-stream", feed, "--once", "--checkpoint"]
    main([*common, str(tmp_path / "c1"), "--json", str(tmp_path / "json"), "--doc-id"])
    main([*common, str(tmp_path / "c2"), "--table", "streamed"])
    main([*common, str(tmp_path / "c3"), "--upsert", "stream_upsert", "--order-by", "update_timestamp"])
    assert spark.read.json(str(tmp_path / "json")).where("doc_id is not null").count() == 2
    assert spark.table("streamed").count() == 2
    assert current_state(spark, "stream_upsert", "event_id").count() == 2


def test_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["xml-stream", "in", "--checkpoint", "c"])
    args = parser().parse_args(["kafka-stream", "h:1", "events", "--checkpoint", "c", "--index", "spark/events"])
    assert (args.topic, args.starting, args.key) == ("events", "latest", "event_id")


def test_broken_records_go_beside_the_output(spark, tmp_path, feed):
    main(["xml-to-csv", feed, str(tmp_path / "out")])
    aside = [r.value for r in spark.read.text(str(tmp_path / "out_quarantine")).collect()]
    assert len(aside) == 1 and "<net id=broken>" in aside[0]
    main(["xml-to-csv", feed, str(tmp_path / "out2"), "--quarantine", str(tmp_path / "aside")])
    assert spark.read.text(str(tmp_path / "aside")).count() == 1
    main(["xml-to-table", feed, "--table", "with_aside"])
    assert spark.table("with_aside_quarantine").count() == 1


def test_json_by_record_and_by_event(spark, tmp_path, feed):
    for large in ([], ["--large-documents"]):
        out = str(tmp_path / f"out{len(large)}")
        main(["xml-to-json", feed, str(tmp_path / f"archive{len(large)}"), out, *large])
        assert sorted(r.event_id for r in spark.read.json(out).collect()) == ["1", "2"]


def test_stream_bounds_and_ids(spark, tmp_path, feed):
    (tmp_path / "in" / "b.xml").write_text('<eventData><net id="7"><event id="3"/><event id="4"></event></net></eventData>')
    main(["xml-stream", feed, "--once", "--checkpoint", str(tmp_path / "c"), "--json", str(tmp_path / "json"), "--max-files", "1"])
    rows = spark.read.json(str(tmp_path / "json"))
    assert {r.event_id for r in rows.where("doc_id is not null").collect()} >= {"1", "4"}
    assert {p.name for p in (tmp_path / "json").glob("batch_id=*")} == {"batch_id=0", "batch_id=1"}
    args = parser().parse_args(["kafka-stream", "h", "t", "--checkpoint", "c", "--table", "x", "--max-offsets", "10"])
    assert args.max_offsets == "10"


def test_rows_without_a_key_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("event_id,x\n1,a\n,b\n")
    main(["csv-to-upsert", str(tmp_path / "a.csv"), "some_keyless"])
    assert current_state(spark, "some_keyless").count() == 1
    assert [r.x for r in spark.table("some_keyless_quarantine").collect()] == ["b"]

"""What staged feeds move, and what queries and packing take for them."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from feedworks.operators.events import event_records
from feedworks.plans import queries, staging
from feedworks.sinks.small_files import pack_files, pack_table
from feedworks.sinks.tables import replace_batch
from feedworks.sinks.files import write_batch
from feedworks.sources import xml_records
from feedworks.sources.xml import _network
from feedworks.schema import NETWORK

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.fixture
def folder(spark, tmp_path):
    """Events, some with nulls, one twice."""
    kinds = ["view", "click", "error", "signup", "purchase", None]
    rows = [(n, datetime.datetime(2024, 1, 1, 0, n % 60), n % 7 if n % 11 else None, kinds[n % 6],
             n / 4 if n % 13 else None, '{"k": %d}' % n) for n in range(1000)]
    spark.createDataFrame([*rows, rows[5]], EVENTS).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


@pytest.fixture
def written(monkeypatch):
    """The plans of what is written, from top to bottom."""
    plans = []
    for name in ("save", "text", "parquet"):
        def write(self, *args, _write=getattr(DataFrameWriter, name), **options):
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
            return _write(self, *args, **options)
        monkeypatch.setattr(DataFrameWriter, name, write)
    return plans


@pytest.mark.parametrize("stage", ["events_xml", "wrapped_xml", "broken_xml", "half_empty_xml", "large_document"])
def test_xml_is_made_after_the_rows_have_moved(spark, folder, written, stage):
    getattr(staging, stage)(spark, folder)
    plan = written[-1]
    moved = plan[plan.index("RepartitionByExpression"):]
    assert "Événement" in plan and "Événement" not in moved and "parquet" in moved


def test_no_file_is_moved_as_one_row(spark, folder, written):
    path = staging.half_empty_xml(spark, folder)
    assert all("Relation [value" not in plan for plan in written)
    events, n = event_records(xml_records(spark, path)), staging.n_files(staging.table(spark, folder, "events"))
    assert events.count() == 1001
    assert sum(name.startswith("part-") for name in os.listdir(path.removeprefix("file:"))) == 2 * n


def test_whole_files_are_small(spark, folder, monkeypatch):
    monkeypatch.setattr(staging, "_RECORDS_PER_WHOLE_FILE", 2)
    path = staging.wrapped_xml(spark, folder)
    records = spark.read.text(path, wholetext=True).select((F.size(F.split("value", "<eventData>")) - 1).alias("n"))
    assert records.agg(F.max("n"), F.sum("n")).first() == (2, 16)
    assert event_records(xml_records(spark, path, whole_files=True)).count() == 1001


def test_whole_files_are_parsed_a_record_at_a_time(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<feed><!-- <eventData> --><eventData><net id="1"><event id="7"></event></net></eventData></eventData></feed>')
    records = xml_records(spark, str(tmp_path / "a.xml"), whole_files=True)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 2 and "from_xml" not in plan[plan.index("Generate explode"):]
    assert [r.net and r.net[0].event[0]["_id"] for r in records.collect()] == ["7", None]


def test_streamed_document_stages_no_other_feed(spark, folder):
    assert queries.stream_large_document(spark, folder).count() == 1001
    assert [name for _, of, name in staging._staged if of == folder] == ["large_document"]


def test_network_tags_read_by_pattern_and_by_parser_agree(spark):
    tags = ['<net id="1" name="user-1">', '<net id="1" name="user-1"/>', '<net id="1" name="a&amp;b">', '<net name="x" id="2">',
            "<net id='3' name='y'>", '<net id="4">', '<net id="" name="z">', '<net id=" 5 " name="z">', '<net id="6"  name="z" >', "<net>"]
    rows = spark.createDataFrame([(t,) for t in tags], "tag string")
    parsed = F.from_xml(F.regexp_replace("tag", r"\s*/?>$", "/>"), NETWORK)
    unknown = F.struct(*[F.lit(None).cast("string").alias(n) for n in NETWORK.names])
    for row in rows.select("tag", _network(F.col("tag"), unknown).alias("is"), F.coalesce(parsed, unknown).alias("was")).collect():
        assert row["is"] == row["was"], row


def test_packing_does_not_sort(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    for method in ("save", "insertInto"):
        def write(self, *args, _write=getattr(DataFrameWriter, method), **options):
            seen.append(spark.conf.get(name))
            return _write(self, *args, **options)
        monkeypatch.setattr(DataFrameWriter, method, write)
    before = spark.conf.get(name)
    path, table = str(tmp_path / "files"), "packed_without_sort"
    for number in range(4):
        replace_batch(spark.range(number * 10, number * 10 + 10, 1, 3), table, number, str(tmp_path / "table"))
        write_batch(spark.range(number * 10, number * 10 + 10, 1, 3), path, number)
    seen.clear()
    assert pack_files(spark, path) == 1 and pack_table(spark, table) == 1
    assert len(seen) == 3 and all(int(n) > 0 for n in seen) and spark.conf.get(name) == before
    for rows in (spark.read.parquet(path), spark.table(table)):
        assert sorted((r.id, r.batch_id) for r in rows.collect()) == [(n, 3 if n >= 30 else 2) for n in range(40)]
    spark.sql(f"DROP TABLE {table}")

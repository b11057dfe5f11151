import json
import uuid

import pytest
from pyspark.sql import functions as F

from feedworks.operators.events import event_records
from feedworks.sinks import current_state
from feedworks.sources import xml_records, xml_stream
from feedworks.streaming import (
    files_sink, input_rows, run, sinks_together, table_sink, upsert_sink,
)


def feed(folder, name, first, n, severity="1"):
    folder.mkdir(exist_ok=True)
    events = "".join(f'<event id="{i}"><severity>{severity}</severity></event>' for i in range(first, first + n))
    (folder / name).write_text(f'<eventData><net id="1">{events}</net></eventData>')


def work_off(spark, tmp_path, sink, source="in", **settings):
    stream = xml_stream(spark, str(tmp_path / source), maxFilesPerTrigger=1)
    query = run(stream, sink, transform=event_records, checkpoint=str(tmp_path / "checkpoint"),
                interval=None, **settings)
    query.awaitTermination()
    return query


def json_ids(spark, path):
    return sorted(int(r.event_id) for r in spark.read.json(str(path)).select("event_id").collect())


def test_stream_equals_batch_over_a_restart(spark, tmp_path):
    for i in range(3):
        feed(tmp_path / "in", f"{i}.xml", 10 * i, 5)
    sink = files_sink(str(tmp_path / "out"))
    query = work_off(spark, tmp_path, sink)
    assert input_rows(query) == 3
    feed(tmp_path / "in", "3.xml", 30, 5)
    work_off(spark, tmp_path, sink)
    work_off(spark, tmp_path, sink)
    batch = event_records(xml_records(spark, str(tmp_path / "in")))
    assert json_ids(spark, tmp_path / "out") == sorted(int(r.event_id) for r in batch.collect())
    assert sorted(p.name for p in (tmp_path / "out").glob("batch_id=*")) == [f"batch_id={i}" for i in range(4)]


@pytest.mark.parametrize("kind", ["files", "table", "upsert"])
def test_failed_batch_is_not_doubled(spark, tmp_path, kind):
    for i in range(3):
        feed(tmp_path / "in", f"{i}.xml", 10 * i, 5)
    inner = {"files": files_sink(str(tmp_path / "out")), "table": table_sink(f"failing_{kind}"),
             "upsert": upsert_sink("failing_upsert", "event_id")}[kind]

    def fails_after_writing(batch, batch_id):
        inner(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        work_off(spark, tmp_path, fails_after_writing)
    work_off(spark, tmp_path, inner)
    if kind == "files":
        ids = json_ids(spark, tmp_path / "out")
    else:
        df = spark.table("failing_table") if kind == "table" else current_state(
            spark, "failing_upsert", "event_id")
        ids = sorted(int(r.event_id) for r in df.collect())
    assert ids == sorted(10 * i + j for i in range(3) for j in range(5))


def test_upsert_keeps_the_latest_batch(spark, tmp_path):
    feed(tmp_path / "in", "0.xml", 0, 4, severity="1")
    sink = upsert_sink("latest_batch", "event_id")
    work_off(spark, tmp_path, sink)
    feed(tmp_path / "in", "1.xml", 2, 4, severity="9")
    work_off(spark, tmp_path, sink)
    state = {r.event_id: r.severity for r in current_state(spark, "latest_batch", "event_id").collect()}
    assert state == {"0": "1", "1": "1", **{str(i): "9" for i in range(2, 6)}}


def test_empty_batches_and_two_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.xml").write_text('<eventData><net id="1"></net></eventData>')
    seen = []
    both = sinks_together(files_sink(str(tmp_path / "out")), files_sink(str(tmp_path / "copy"), "parquet"),
                          lambda batch, batch_id: seen.append(batch_id))
    work_off(spark, tmp_path, both, skip_empty=True)
    assert seen == []
    feed(tmp_path / "in", "1.xml", 0, 3)
    work_off(spark, tmp_path, both, skip_empty=True)
    assert seen == [1]
    assert json_ids(spark, tmp_path / "out") == [0, 1, 2]
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 3


@pytest.mark.parametrize("kind", ["files", "table"])
def test_empty_batches_leave_nothing_and_cost_no_job(spark, tmp_path, kind):
    """Ten batches, of which every other one gives no row: a job each, five partitions."""
    source, path, name = str(tmp_path / "in"), str(tmp_path / "out"), f"t_{uuid.uuid4().hex[:12]}"
    for i in range(10):
        spark.range(100 * i, 100 * i + 10).repartition(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    sink = files_sink(path, "parquet") if kind == "files" else table_sink(name, path)
    odd = lambda df: df.where("id div 100 % 2 = 1")
    query = run(stream, sink, transform=odd, checkpoint=str(tmp_path / "cp"), interval=None, skip_empty=True)
    query.awaitTermination()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))
    # The first batch of a table looks for those that an older release may have left.
    assert jobs == 10 + (kind == "table")
    assert len(list((tmp_path / "out").glob("batch_id=*"))) == 5
    rows = spark.read.parquet(path) if kind == "files" else spark.table(name)
    assert sorted(r.id for r in rows.collect()) == [100 * i + k for i in range(1, 10, 2) for k in range(10)]
    if kind == "table":
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 5
        spark.sql(f"DROP TABLE {name}")


def test_new_checkpoint_on_an_old_output_is_refused(spark, tmp_path):
    for i in range(2):
        feed(tmp_path / "in", f"{i}.xml", 10 * i, 2)
    sink = files_sink(str(tmp_path / "out"))
    work_off(spark, tmp_path, sink)
    stream = xml_stream(spark, str(tmp_path / "in"))
    query = run(stream, sink, transform=event_records, checkpoint=str(tmp_path / "other"), interval=None)
    with pytest.raises(Exception, match="comes after batch 1"):
        query.awaitTermination()
    assert len(json_ids(spark, tmp_path / "out")) == 4


def test_interval_trigger(spark, tmp_path):
    feed(tmp_path / "in", "0.xml", 0, 2)
    query = run(xml_stream(spark, str(tmp_path / "in")), files_sink(str(tmp_path / "out")),
                transform=event_records, checkpoint=str(tmp_path / "c"), name="feed")
    try:
        assert query.name == "feed"
        query.processAllAvailable()
        assert json_ids(spark, tmp_path / "out") == [0, 1]
        assert json.loads(query.lastProgress.json)["name"] == "feed"
    finally:
        query.stop()


def test_table_without_batches(spark, tmp_path):
    feed(tmp_path / "in", "0.xml", 0, 2)
    work_off(spark, tmp_path, table_sink("appended", per_batch=False))
    feed(tmp_path / "in", "1.xml", 2, 2)
    work_off(spark, tmp_path, table_sink("appended", per_batch=False))
    assert spark.table("appended").count() == 4 and len(spark.table("appended").columns) == 21


def test_rows_are_counted_past_the_kept_history(spark, tmp_path, settings):
    settings(sql_streaming_numRecentProgressUpdates=2)
    for i in range(5):
        feed(tmp_path / "in", f"{i}.xml", 10 * i, 1)
    query = work_off(spark, tmp_path, files_sink(str(tmp_path / "out")))
    assert len(query.recentProgress) <= 2 and input_rows(query) == 5


def test_files_with_an_old_time_arrive(spark, tmp_path):
    import os
    import time

    feed(tmp_path / "in", "0.xml", 0, 2)
    work_off(spark, tmp_path, files_sink(str(tmp_path / "out")))
    feed(tmp_path / "in", "1.xml", 10, 2)
    old = time.time() - 400 * 86400
    os.utime(tmp_path / "in" / "1.xml", (old, old))
    work_off(spark, tmp_path, files_sink(str(tmp_path / "out")))
    assert json_ids(spark, tmp_path / "out") == [0, 1, 10, 11]


def test_crash_in_the_first_batch_of_a_table(spark, tmp_path):
    feed(tmp_path / "in", "0.xml", 0, 3)
    inner = table_sink("crashed_first", str(tmp_path / "t"))

    def fails(batch, batch_id):
        # Files at the place of the table, but no table, as after a crash while it is made.
        batch.write.partitionBy("event_id").mode("overwrite").parquet(str(tmp_path / "t" / "batch_id=0"))
        raise RuntimeError("lost before the table")

    with pytest.raises(Exception, match="lost before the table"):
        work_off(spark, tmp_path, fails)
    work_off(spark, tmp_path, inner)
    assert sorted(r.event_id for r in spark.table("crashed_first").collect()) == ["0", "1", "2"]


def test_broken_records_and_events_without_id_are_set_aside(spark, tmp_path):
    from feedworks.plans import jobs

    feed(tmp_path / "in", "0.xml", 0, 2)
    (tmp_path / "in" / "1.xml").write_text('<eventData><net id="1"><event><severity>5</severity></event>'
                                           '<event id="7"></event></net></eventData>\n<eventData><net id=></eventData>')
    sink = upsert_sink("with_keyless", "event_id", keyless=files_sink(str(tmp_path / "keyless")))
    for _ in range(2):
        jobs.xml_stream_to(spark, str(tmp_path / "in"), sink, str(tmp_path / "c"), interval=None).awaitTermination()
    assert sorted(r.event_id for r in current_state(spark, "with_keyless").collect()) == ["0", "1", "7"]
    assert [r.severity for r in spark.read.json(str(tmp_path / "keyless")).collect()] == ["5"]
    aside = [r.value for r in spark.read.text(str(tmp_path / "c_quarantine")).collect()]
    assert len(aside) == 1 and "<net id=>" in aside[0]


def test_upsert_sink_compacts(spark, tmp_path):
    for i in range(5):
        feed(tmp_path / "in", f"{i}.xml", i, 2, severity=str(i))
    work_off(spark, tmp_path, upsert_sink("compacting", "event_id", compact_every=2))
    state = {r.event_id: r.severity for r in current_state(spark, "compacting").collect()}
    assert len(state) == 6 and spark.table("compacting").count() > 0
    assert all(state[str(i)] == str(min(i, 4)) for i in range(1, 6)) or state["5"] == "4"


def test_messages_read_again_in_other_batches(spark, tmp_path):
    """A stream that begins anew, its checkpoint lost, at other batch borders."""
    from feedworks.plans.jobs import message_ids
    from feedworks.schema import MESSAGE_COLUMNS
    from feedworks.sources import as_messages
    from feedworks.sources.kafka import PLACE

    filled = lambda **fields: ",".join(fields.get(c, "x") for c in MESSAGE_COLUMNS)
    log = [(filled(NETWORK_ID=f"n{i}", EVENT_ID=f"e{i % 7}"), "t", i % 2, i // 2) for i in range(60)]
    for part in range(6):
        rows = [(None, text.encode(), topic, p, offset, None) for text, topic, p, offset in log[10 * part:10 * part + 10]]
        spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp").coalesce(
            1).write.mode("append").parquet(str(tmp_path / "log"))
    schema = spark.read.parquet(str(tmp_path / "log")).schema
    sink = upsert_sink("replayed", "event_id", ["offset", "partition"], compact_every=2, replay_safe=True)
    for number, files in enumerate([1, 4]):
        stream = as_messages(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "log")))
        run(stream, sink, transform=lambda rows: message_ids(rows, keep=PLACE), interval=None,
            checkpoint=str(tmp_path / f"checkpoint{number}")).awaitTermination()
        newest = {}
        for text, _, p, offset in sorted(log, key=lambda row: (row[3], row[2])):
            fields = dict(zip(MESSAGE_COLUMNS, text.split(",")))
            newest[fields["EVENT_ID"]] = fields["NETWORK_ID"]
        assert {r.event_id: r.network_id for r in current_state(spark, "replayed").collect()} == newest

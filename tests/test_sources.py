from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceWriter, SimpleDataSourceStreamReader, WriterCommitMessage,
)

from feedworks import workspace
from feedworks.operators import messages
from feedworks.schema import CORRUPT
from feedworks.plans import jobs
from feedworks.schema import MESSAGE_COLUMNS
from feedworks.sinks import current_state, index_options, write_index
from feedworks.sources import balanced_predicates, delimited, jdbc_options, kafka_options
from feedworks.streaming import upsert_sink


def test_delimited(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("event_id\tname\n001\t\n2\tx y\n")
    df = delimited(spark, str(tmp_path / "a.tsv"), sep="\t")
    assert df.dtypes == [("event_id", "string"), ("name", "string")]
    assert [tuple(r) for r in df.collect()] == [("001", None), ("2", "x y")]


def decoded(spark, *values, **kw):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return [tuple(r) for r in messages.decode_csv(df, **kw).drop(CORRUPT).collect()]


def row(*fields):
    return tuple(fields) + (None,) * (26 - len(fields))


def test_messages(spark):
    full = [f"f{i}" for i in range(26)]
    assert decoded(spark, ",".join(full), "1,2,3", "1,,3,,,", '1,"x,y",3', "") == [
        tuple(full), row("1", "2", "3"), row("1", None, "3"), row("1", "x,y", "3"), row()]


def test_messages_without_quoting(spark):
    assert decoded(spark, "1,,3,,,", '1,"x,y"', ",,", "", quoting=False) == [
        row("1", "", "3"), row("1", '"x', 'y"'), row(), row("")]
    assert decoded(spark, "1^2^^", quoting=False, sep="^") == [row("1", "2")]


def test_messages_that_do_not_fit_keep_their_text(spark):
    long, open_quote = ",".join(map(str, range(30))), 'a,"b,c'
    fits = ["1,2", ",".join(["x"] * 26) + ",,,", '1,"a, ""b"", c",2', "a\"b,c", ""]
    for values, kw, unfit in [
            ([long, open_quote, *fits], {}, [long, open_quote]),
            ([long, "1^2"], {"quoting": False}, [long]),
            (["^".join(map(str, range(27)))], {"sep": "^"}, ["^".join(map(str, range(27)))])]:
        df = spark.createDataFrame([(v,) for v in values], "value string")
        assert sorted(r[0] for r in messages.decode_csv(df, **kw).select(CORRUPT).collect() if r[0]) == sorted(unfit)


def test_message_ids(spark):
    df = spark.createDataFrame([("r,e1,n1",)], "value string")
    out = messages.project_ids(messages.decode_csv(df))
    assert out.columns == ["network_id", "event_id"] and out.first() == ("n1", "e1")
    assert len(MESSAGE_COLUMNS) == 26 == len(set(MESSAGE_COLUMNS))


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "wine", user="u", password="p", driver="d") == {
        "url": "jdbc:x", "dbtable": "wine", "user": "u", "password": "p", "driver": "d",
        "fetchsize": "10000"}
    ranges = jdbc_options("jdbc:x", "wine", partition_column="id", lower=0, upper=100, num_partitions=8)
    assert ranges["partitionColumn"] == "id" and ranges["numPartitions"] == "8" and ranges["lowerBound"] == "0"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "wine", partition_column="id")


@pytest.mark.parametrize("kind", ["skewed", "one value", "few", "doubles", "nulls"])
def test_balanced_predicates(spark, kind):
    skewed = F.expr("CAST(pow(id, 3) AS BIGINT)")
    value = {"skewed": skewed, "one value": F.lit(7).cast("long"), "few": F.col("id") % 3, "doubles": F.exp(F.col("id") / 400),
             "nulls": F.when(F.col("id") % 10 > 0, skewed)}[kind]
    df = spark.range(4000).select(value.alias("v"))
    # Values that the sample lacks count too.
    predicates = balanced_predicates(df.where("v IS NOT NULL").sample(0.5, seed=1), "v", 8)
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == 4000 and len(predicates) <= 8
    met = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert df.where(met != 1).count() == 0
    if kind in ("skewed", "doubles"):
        assert len(predicates) == 8 and max(counts) < 2 * 4000 / 8
    assert balanced_predicates(df.where("v IS NOT NULL"), "v", 1) == ["1 = 1"]


def test_kafka_options():
    assert kafka_options("h:1", "events", group="test1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "events", "startingOffsets": "latest",
        "kafka.group.id": "test1"}


def recorder():
    """Stands in for an index connector: notes rows and options in a file.
    Made inside a function, so that it travels to the workers by value."""

    class RecorderWriter(DataSourceWriter):
        def __init__(self, options, overwrite):
            self.options, self.overwrite = options, overwrite

        def write(self, rows):
            line = (sum(1 for _ in rows), self.overwrite, self.options["es.mapping.id"],
                    self.options["es.write.operation"])
            with open(self.options["out"], "a") as out:
                out.write(" ".join(map(str, line)) + "\n")
            return WriterCommitMessage()

    class Recorder(DataSource):
        @classmethod
        def name(cls):
            return "recorder"

        def schema(self):
            return "event_id string"

        def writer(self, schema, overwrite):
            return RecorderWriter(dict(self.options), overwrite)

    return Recorder


def test_index_options_reach_the_connector(spark, tmp_path):
    spark.dataSource.register(recorder())
    options = index_options("spark/events", "h:9200")
    assert options == {
        "es.nodes": "h:9200", "es.resource": "spark/events", "es.index.auto.create": "true",
        "es.mapping.id": "event_id", "es.write.operation": "upsert"}
    df = spark.createDataFrame([("1",)], "event_id string").coalesce(1)
    write_index(df, {**options, "out": str(tmp_path / "log")}, fmt="recorder")
    assert "1 False event_id upsert" in (tmp_path / "log").read_text()
    assert "es.write.operation" not in index_options("a/b", "h", key=None, upsert=False)


def test_workspace_uses_the_shared_folder(spark):
    assert workspace.root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workspace.new_path(spark, "x") != workspace.new_path(spark, "x")
    df = workspace.materialise(spark.range(5), "numbers")
    assert df.inputFiles()[0].removeprefix("file://").startswith(workspace.root(spark))
    assert df.count() == 5


def broker():
    """Stands in for the Kafka connector: two messages, then nothing."""

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            rows = [("k", b"r1,e1,n1"), (None, b"r2,e2,n2")] if start["n"] == 0 else []
            return iter([(k, v, "events", 0, i, None) for i, (k, v) in enumerate(rows)]), {"n": 2}

        def readBetweenOffsets(self, start, end):
            return self.read(start)[0]

        def commit(self, end):
            pass

    class Broker(DataSource):
        @classmethod
        def name(cls):
            return "broker"

        def schema(self):
            assert self.options["subscribe"] == "events" and self.options["startingoffsets"] == "latest"
            return ("key string, value binary, topic string, partition int, offset long, "
                    "timestamp timestamp")

        def simpleStreamReader(self, schema):
            return Reader()

    return Broker


def test_kafka_to_upsert(spark, tmp_path):
    spark.dataSource.register(broker())
    query = jobs.kafka_to(spark, "h:1", "events", upsert_sink("from_kafka", "event_id"),
                          str(tmp_path / "checkpoint"), interval="1 second", fmt="broker")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    state = current_state(spark, "from_kafka", "event_id").select("network_id", "event_id")
    assert sorted(tuple(r) for r in state.collect()) == [("n1", "e1"), ("n2", "e2")]


class Session:
    """As much of a session as the workspace asks for."""

    def __init__(self, master, folder=None, checkpoint=None):
        self.conf = {"spark.sql.warehouse.dir": "/warehouse/", **({"spark.checkpoint.dir": folder} if folder else {})}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint)


def test_workspace_on_a_cluster():
    assert workspace.root(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared/feedworks/app-1"
    with pytest.raises(RuntimeError):
        workspace.root(Session("yarn"))
    assert workspace.root(Session("yarn", checkpoint="hdfs:///points")) == "hdfs:///points/feedworks/app-1"
    assert workspace.root(Session("local[2]")) == workspace.root(Session("local[2]"))
    assert workspace.root(Session("local[2]")) == "/warehouse/_shared/feedworks/app-1"


def test_scratch_is_freed_alone(spark):
    kept = workspace.new_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with workspace.scratch(spark):
        table = workspace.materialise(spark.range(5), "inner")
        assert table.count() == 5
        gone = table.inputFiles()[0].rsplit("/", 1)[0]
    fs, folder = workspace._folder(spark, gone)
    assert not fs.exists(folder) and spark.read.parquet(kept).count() == 3


def test_notes_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert workspace.read_note(spark, path, "x") == {}
    for n in range(3):
        workspace.write_note(spark, path, "x", {"n": n, "ü": "é"})
    assert workspace.read_note(spark, path, "x") == {"n": 2, "ü": "é"}

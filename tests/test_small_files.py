"""Packing of batches: the same rows, few files, over failures and with batches of all sizes."""

import random
import uuid
from pathlib import Path

import pytest
from hypothesis import given, settings as trials, strategies as st
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.sinks import keyed_upsert, pack_files, pack_table, small_files, write_batch
from feedworks.sinks.small_files import n_files, runs_to_pack
from feedworks.sinks.tables import replace_batch
from feedworks.streaming import files_sink, run, table_sink


def data_files(path):
    return [f for f in Path(path).rglob("batch_id=*/part-*") if "_packed" not in str(f)]


def batches_of(path):
    return sorted(int(f.name.split("=")[1]) for f in Path(path).glob("batch_id=*"))


def rows_of(spark, path, fmt):
    read = spark.read.option("mergeSchema", True).parquet(path) if fmt == "parquet" else spark.read.schema("id long, word string").json(path)
    return sorted((r.id, r.word) for r in read.select("id", "word").collect())


def some_rows(spark, first, n, parts):
    return spark.range(first, first + n, 1, parts).select("id", F.concat(F.lit("word "), F.col("id") % 7).alias("word"))


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:12]}"
    yield name, str(tmp_path / "table")
    for each in (name, f"{name}_log"):
        spark.sql(f"DROP TABLE IF EXISTS {each}")


SIZED = st.lists(st.tuples(st.integers(0, 300), st.integers(0, 40)), max_size=40).map(
    lambda sizes: [(i, size, files) for i, (size, files) in enumerate(sizes)])


@trials(deadline=None, max_examples=300)
@given(SIZED)
def test_runs(batches):
    runs = runs_to_pack(batches, 100)
    places = [number for run in runs for number, _, _ in run]
    assert places == sorted(set(places))
    for one in runs:
        numbers = [number for number, _, _ in one]
        assert numbers == list(range(numbers[0], numbers[-1] + 1))
        assert len(one) > 1 or one[0][2] > 2 * n_files(one[0][1], 100)
        # No run is longer than its target by more than its last batch.
        assert sum(size for _, size, _ in one[:-1]) < 100


def test_rewriting_grows_as_a_logarithm():
    """Batches of one size, packed after each: how often a byte is written."""
    written, held = 0, []
    for number in range(512):
        held.append((number, 1, 4))
        for one in runs_to_pack(held, 512):
            size = sum(s for _, s, _ in one)
            written += size
            held = [b for b in held if b[0] not in {n for n, _, _ in one}] + [(one[-1][0], size, 1)]
            held.sort()
    assert len(held) <= 12
    assert written <= 512 * 12


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_files_are_packed_into_few(spark, tmp_path, fmt):
    path, expected = str(tmp_path / "out"), []
    for i in range(9):
        n = 0 if i in (0, 4) else 50 * i
        write_batch(some_rows(spark, 1000 * i, n, 5), path, i, fmt)
        expected += range(1000 * i, 1000 * i + n)
    assert pack_files(spark, path, fmt) == 1
    assert batches_of(path) == [7, 8]
    assert len(list(Path(path, "batch_id=7").glob("part-*"))) == 1
    assert [i for i, _ in rows_of(spark, path, fmt)] == expected
    assert not Path(path, "_packed").exists()
    assert pack_files(spark, path, fmt) == 0
    # The newest batch may still come again.
    write_batch(some_rows(spark, 8000, 3, 1), path, 8, fmt)
    assert [i for i, _ in rows_of(spark, path, fmt)] == [i for i in expected if i < 8000] + [8000, 8001, 8002]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_files_stay_near_their_target(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    for i in range(6):
        write_batch(some_rows(spark, 10_000 * i, 4000 if i == 2 else 400, 12), path, i, fmt)
    before, total = rows_of(spark, path, fmt), sum(f.stat().st_size for f in data_files(path))
    pack_files(spark, path, fmt, target_bytes=total // 5)
    assert rows_of(spark, path, fmt) == before
    packed = [f for f in data_files(path) if "batch_id=5" not in str(f)]
    assert len(packed) <= 7
    if fmt == "json":
        assert max(f.stat().st_size for f in packed) <= 1.1 * total / 5


def test_empty_batches_alone(spark, tmp_path):
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        for i in range(4):
            write_batch(some_rows(spark, 0, 0, 2), path, i, fmt)
        pack_files(spark, path, fmt)
        assert batches_of(path) == [2, 3]
        assert rows_of(spark, path, fmt) == []
    assert pack_files(spark, str(tmp_path / "nothing")) == 0


def test_columns_of_all_batches_are_kept(spark, tmp_path):
    path = str(tmp_path / "out")
    write_batch(some_rows(spark, 0, 3, 1), path, 0)
    write_batch(some_rows(spark, 3, 3, 1).withColumn("more", F.col("id") * 2), path, 1)
    write_batch(some_rows(spark, 6, 1, 1), path, 2)
    pack_files(spark, path)
    got = {r.id: r.more for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert got == {0: None, 1: None, 2: None, 3: 6, 4: 8, 5: 10, 6: None}


def test_text_with_any_content(spark, tmp_path):
    path, rng = str(tmp_path / "out"), random.Random(4)
    words = ["".join(rng.choices('ab"\\\n\r é,{}', k=rng.randint(0, 9))) for _ in range(60)]
    for i in range(6):
        part = spark.createDataFrame(list(enumerate(words))[10 * i:10 * i + 10], "id long, word string")
        write_batch(part, path, i, "json")
    assert pack_files(spark, path, "json") == 1
    assert rows_of(spark, path, "json") == list(enumerate(words))


@pytest.mark.parametrize("at", [0, 1, 2, 3])
def test_files_cut_short(spark, tmp_path, monkeypatch, at):
    """Dying at any step of the swap: what comes next finishes it."""
    path = str(tmp_path / "out")
    for i in range(5):
        write_batch(some_rows(spark, 10 * i, 10, 2), path, i)
    before, steps, delete = rows_of(spark, path, "parquet"), [], workspace.delete

    def dies(session, target):
        if len(steps) == at:
            raise RuntimeError("lost")
        steps.append(target)
        delete(session, target)
    monkeypatch.setattr(small_files, "delete", dies)
    with pytest.raises(RuntimeError, match="lost"):
        pack_files(spark, path)
    monkeypatch.undo()
    files_sink(path, "parquet", pack_every=100)(some_rows(spark, 50, 1, 1), 5)
    assert batches_of(path) == [3, 4, 5]
    assert rows_of(spark, path, "parquet") == [*before, (50, "word 1")]


@pytest.mark.parametrize("step", ["overwrite_partitions", "drop_batch", "delete"])
def test_tables_are_packed_also_when_cut_short(spark, table, monkeypatch, step):
    name, path = table
    for i in range(6):
        replace_batch(some_rows(spark, 10 * i, 0 if i == 3 else 10, 3), name, i, path)
    before = sorted(map(tuple, spark.table(name).select("id", "word").collect()))

    def dies(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(small_files, step, dies)
    with pytest.raises(RuntimeError, match="lost"):
        pack_table(spark, name)
    monkeypatch.undo()
    table_sink(name, path, pack_every=100)(some_rows(spark, 60, 1, 1), 6)
    assert sorted(map(tuple, spark.table(name).select("id", "word").collect())) == [*before, (60, "word 4")]
    assert batches_of(path) == [4, 5, 6]
    assert len(list(Path(path, "batch_id=4").glob("part-*"))) == 1
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["batch_id=4", "batch_id=5", "batch_id=6"]


def test_refused(spark, tmp_path, table):
    name, path = table
    with pytest.raises(ValueError, match="csv"):
        files_sink(str(tmp_path / "c"), "csv", pack_every=5)
    keyed_upsert(some_rows(spark, 0, 3, 1), name, "id", batch_id=0, path=path)
    with pytest.raises(ValueError, match="upsert"):
        pack_table(spark, f"{name}_log")


def test_stream_over_a_restart(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    some_rows(spark, 0, 600, 12).write.parquet(source)
    stream = spark.readStream.schema("id long, word string").option("maxFilesPerTrigger", 1).parquet(source)
    sink, deaths = files_sink(path, "parquet", pack_every=4), []

    def dying(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 8 and not deaths:
            deaths.append(batch_id)
            raise RuntimeError("lost after the write")
    for again in (False, True):
        query = run(stream, dying, checkpoint=str(tmp_path / "checkpoint"), interval=None)
        if again:
            query.awaitTermination()
        else:
            with pytest.raises(Exception, match="lost after the write"):
                query.awaitTermination()
    assert [i for i, _ in rows_of(spark, path, "parquet")] == list(range(600))
    assert len(data_files(path)) <= 6

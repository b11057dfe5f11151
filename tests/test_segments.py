import random

import pytest
from pyspark.sql import functions as F

from feedworks.functions import has_marker, is_subject_line
from feedworks.operators.segments import catalogue_subjects, fold
from feedworks.sources import delimited


def one_pass(rows, is_end, keep):
    """What a single reader of the rows would give."""
    out, buffer = [], []
    for tag, text in rows:
        if is_end(tag):
            out.append((text, "~~".join(buffer)))
            buffer = []
        elif keep(text):
            buffer.append(text)
    return out


def export(folder, rows, name="detail.csv"):
    folder.mkdir(exist_ok=True)
    lines = ["Tag\tText"] + [f"{t or ''}\t{x or ''}" for t, x in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def result(df):
    return sorted(((r.Accessno, r.Subjects) for r in df.collect()), key=str)


CASES = [
    ("Subject", "1. Algebra"), ("Subject", "20. dropped"), ("Subject", "29. kept"),
    ("Subject", "IV. kept"), ("Subject", "X. dropped"), (None, None), ("Note", None),
    (None, "10. kept too"), ("Accn Nos", "A1"), ("Accn Nos :", "A2"), ("Subject", "2. Physics"),
    ("The Accn Nos", "A1"), ("Accn Nos", None), ("Subject", "3. never closed"),
]
EXPECTED = [("A1", "1. Algebra~~29. kept~~IV. kept~~10. kept too"), ("A1", "2. Physics"),
            ("A2", ""), (None, "")]


@pytest.mark.parametrize("size", [100_000, 40, 90])
def test_catalogue_cases(spark, tmp_path, small_splits, size):
    small_splits(size)
    df = delimited(spark, export(tmp_path / "x", CASES), sep="\t")
    out = catalogue_subjects(df)
    assert out.columns == ["Accessno", "Subjects"]
    assert result(out) == sorted(EXPECTED, key=str)


def test_no_rows(spark, tmp_path):
    df = delimited(spark, export(tmp_path / "x", []), sep="\t")
    assert catalogue_subjects(df).count() == 0


def random_rows(seed, n=400, ends=0.1):
    rng = random.Random(seed)
    return [("Accn Nos", f"K{i}") if rng.random() < ends
            else (rng.choice(["S", None]), rng.choice([f"{i % 10}. t{i}", f"t{i}", None]))
            for i in range(n)]


def like_reference(rows):
    return one_pass(rows, lambda t: t is not None and "Accn Nos" in t,
                    lambda x: x is not None and any(d + "." in x for d in "123456789"))


@pytest.mark.parametrize("seed,ends,size", [(1, 0.3, 200), (2, 0.02, 150), (3, 0.005, 120)])
def test_random_files_in_splits(spark, tmp_path, small_splits, seed, ends, size):
    rows = random_rows(seed, ends=ends)
    path = export(tmp_path / "x", rows)
    small_splits(size)
    df = delimited(spark, path, sep="\t")
    assert df.rdd.getNumPartitions() > 10
    assert result(catalogue_subjects(df)) == sorted(like_reference(rows), key=str)


def test_files_alone_and_together(spark, tmp_path, small_splits):
    rows = random_rows(4, 200)
    export(tmp_path / "x", rows[:90], "part-0")
    path = export(tmp_path / "x", rows[90:], "part-1")
    small_splits(300)
    df = delimited(spark, path, sep="\t")
    assert result(catalogue_subjects(df)) == sorted(
        like_reference(rows[:90]) + like_reference(rows[90:]), key=str)
    assert result(catalogue_subjects(df, across_files=True)) == sorted(like_reference(rows), key=str)


@pytest.mark.parametrize("block", ["range", "expression"])
def test_groups_with_a_heavy_one(spark, block):
    rows = []
    for g in range(12):
        n = 600 if g == 5 else 20
        rows += [(g, i, t, x) for i, (t, x) in enumerate(random_rows(g, n, 0.1 if g % 3 else 0.0))]
    shuffled = rows[:]
    random.Random(0).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "g int, i long, tag string, text string").repartition(7)
    out = fold(df, partition_by=["g"], order=["i"], is_end=has_marker(F.col("tag"), "Accn Nos"),
               keep=is_subject_line(F.col("text")), key=F.col("text"), value=F.col("text"),
               block=F.expr("i div 50") if block == "expression" else None, names=("k", "v"))
    expected = [(g, *r) for g in range(12) for r in like_reference(
        [(t, x) for h, _, t, x in rows if h == g])]
    assert sorted(tuple(r) for r in out.collect()) == sorted(expected)


def test_subject_pattern_is_the_long_one(spark):
    """The short pattern finds what the spelled-out list of numbers finds."""
    import itertools
    import re
    numbers = [f"{i}." for i in range(1, 13)] + [f"{r}." for r in "I II III IV V VI VII".split()]
    long = re.compile("|".join(re.escape(n) for n in numbers))
    texts = ["".join(t) for n in range(5) for t in itertools.product("0129IVX. a", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    got = {r.t for r in df.where(is_subject_line(F.col("t"))).collect()}
    assert got == {t for t in texts if long.search(t)}

"""Rows of a document table: their identity, and small sides of joins."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedworks import workspace

FILE, AT = "__file", "__at"
#: Two columns that name a row of a file, the same in every scan.
ROW = [FILE, AT]

#: Rows up to which a side of a join is broadcast; beyond it the join shuffles.
SMALL_ROWS = 200_000

#: A word is a run of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns given, with the identity of each row (:data:`ROW`) before them.

    Rows of a file are known by the file and their place in it, so that two
    scans agree without a copy of the table. A frame that doesn't come straight
    from Parquet files is written once.
    """
    try:
        return _numbered(docs, columns)
    except AnalysisException:
        written = workspace.materialise(docs.select(*_as_names(docs, columns)), "rows")
        return _numbered(written, [F.col(f"`{name}`") for name in written.columns])


def on_file(docs: DataFrame) -> DataFrame:
    """``docs``, or a written copy where it doesn't come straight from files: for operators that
    number its rows more than once."""
    try:
        _numbered(docs, ())
    except AnalysisException:
        return workspace.materialise(docs, "documents")
    return docs


def _numbered(docs: DataFrame, columns) -> DataFrame:
    place = docs.metadataColumn("_metadata")
    return docs.select(F.xxhash64(place["file_path"]).alias(FILE), place["row_index"].alias(AT), *columns)


def _as_names(docs: DataFrame, columns) -> list[Column]:
    names = docs.select(*columns).columns
    return [column.alias(name) for column, name in zip(columns, names, strict=True)]


def with_documents(docs: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Whole rows of ``docs`` joined to ``rows`` by identity; other columns of
    ``rows`` follow those of ``docs`` unless ``how`` is a semi join."""
    whole = numbered(docs, F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("__document"))
    joined = whole.join(rows, ROW, how)
    return joined.select("__document.*", *[c for c in joined.columns if c not in (*ROW, "__document")])


#: Rows of whole texts that a Python worker is handed at once, and Spark's own number.
BATCH_ROWS, _SPARK_BATCH_ROWS = 1000, 10_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hands whole texts to Python workers a thousand rows at a time in what is written
    inside it, unless the session has a number of its own. The setting is put back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if int(before) == _SPARK_BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, after telling its session to hand rows to Python a thousand at a time,
    unless the session has a number of its own: ten thousand whole texts, held by Spark and
    by the worker, can be more than an executor has."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(name)) == _SPARK_BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return docs


def text_of(docs: DataFrame) -> Column:
    """The text as a string, null counting as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")


#: Hashes are compared by their lower 63 bits.
_MOST_HASH = (1 << 63) - 1


def hash_bound(rows: int, count: int) -> int:
    """The largest hash in a sample of about ``rows`` of ``count`` rows; that of all where there are no more."""
    return min(_MOST_HASH, (rows << 63) // max(1, count) - 1)


def sampled(key: Column, bound: int | Column) -> Column:
    """Whether a row is in a sample, by its hash and a :func:`hash_bound`."""
    return key.bitwiseAND(F.lit(_MOST_HASH)) <= bound


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has no more than so many rows. ``df``
    should be a written table of a few plain columns: its rows are counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

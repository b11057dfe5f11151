"""File outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedworks.functions import row_json
from feedworks.operators.nested import flatten_structs
from feedworks.workspace import delete, partition_values, read_note, write_note

# Spark's default pattern stops at milliseconds, and its CSV writer trims blanks.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
CSV_OPTIONS = {**JSON_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_DEFAULTS = {"json": JSON_OPTIONS, "csv": CSV_OPTIONS}


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                n_files: int | None = None, **options) -> None:
    """Write ``df`` as Parquet, JSON lines or CSV.

    CSV has no nested columns, so structs are flattened first. ``n_files``
    brings the output together in that many files; the work before it keeps its
    parallelism. Leave it off for large outputs.
    """
    if fmt == "csv":
        df = flatten_structs(df)
    options = {**_DEFAULTS.get(fmt, {}), **options}
    if n_files is not None:
        df = df.repartition(n_files)
    df.write.format(fmt).mode(mode).options(**options).save(path)


def to_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write every row as a line of JSON text."""
    df.select(row_json(df).alias("value")).write.mode(mode).text(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", **options) -> None:
    """Write a batch as the partition ``batch_id=…`` below ``path``.

    Batches come in rising order; the last one may be written again and then
    replaces itself, also by nothing. A lower number means that the checkpoint belongs
    to another output, and is refused before it overwrites an earlier batch. The
    newest number is noted beside the data, so a batch costs the same however many
    came before.
    """
    spark = df.sparkSession
    check_batch(batch_id, newest_batch(spark, path), path)
    options = {**_DEFAULTS.get(fmt, {}), **options}
    df.write.format(fmt).mode("overwrite").options(**options).save(f"{path}/batch_id={int(batch_id)}")
    write_note(spark, path, "batches", {"newest": int(batch_id)})


def retract_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Take back what a batch wrote below ``path``. Its number stays the newest."""
    delete(spark, f"{path}/batch_id={int(batch_id)}")


def newest_batch(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch below ``path``. Outputs without a note are listed once."""
    noted = read_note(spark, path, "batches").get("newest")
    return noted if noted is not None else max(partition_values(spark, path, "batch_id"), default=None)


def check_batch(batch_id: int, newest: int | None, target: str) -> None:
    if newest is not None and batch_id < newest:
        raise ValueError(f"batch {batch_id} of {target} comes after batch {newest}")

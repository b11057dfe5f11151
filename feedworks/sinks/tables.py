"""Catalogue tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.sinks.files import check_batch
from feedworks.workspace import delete


def create_or_append(df: DataFrame, table: str, view: str | None = None,
                     mode: str = "append", fmt: str = "parquet",
                     path: str | None = None, grow: bool = False) -> DataFrame:
    """Append ``df`` to ``table``, or create the table from it.

    Columns go by name. A frame with other columns or types is refused, since an
    insert by position would swap columns without a word; ``grow`` lets the table take on
    columns, see :func:`fitted`. ``mode="overwrite"``
    replaces the table. ``view`` also registers the frame under that name.
    Returns the table.
    """
    spark = df.sparkSession
    if view:
        df.createOrReplaceTempView(view)
    if mode == "append" and spark.catalog.tableExists(table):
        fitted(df, table, grow=grow).write.mode("append").insertInto(table)
    else:
        writer = df.write.format(fmt).mode("overwrite" if mode == "overwrite" else "errorifexists")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
    return spark.table(table)


# Types whose every value the types behind them hold too.
_WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
          "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp_ntz",)}


def fitted(df: DataFrame, table: str, but: str | None = None, grow: bool = False) -> DataFrame:
    """``df`` with its columns in the order of ``table``, column ``but`` aside.

    With ``grow`` columns that are new are added to the table, where earlier rows
    have nulls, columns that ``df`` lacks are null, and values go into a wider type that holds them
    all. A type that would have to change in the table, or lose values, is refused, before
    anything is added. Nested columns have to fit as they are.
    """
    spark = df.sparkSession
    target = {f.name: f.dataType.simpleString() for f in spark.table(table).schema if f.name != but}
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    fits = lambda n: found[n] == target[n] or (grow and target[n] in _WIDER.get(found[n], ()))
    differing = {n for n in found.keys() & target.keys() if not fits(n)}
    if not grow:
        differing |= found.keys() ^ target.keys()
    if differing:
        raise ValueError(f"columns do not fit table {table}: {', '.join(sorted(differing))}")
    if more := [n for n in found if n not in target]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{n}` {found[n]}' for n in more)})")
    return df.select(*[(F.col(f"`{n}`") if n in found else F.lit(None)).cast(kind).alias(n) if found.get(n) != kind else F.col(f"`{n}`")
                       for n, kind in {**target, **{n: found[n] for n in more}}.items()])


def create_table(spark: SparkSession, table: str, columns: list[T.StructField], partition_by: list[str],
                 path: str | None = None, settings: dict[str, str] | None = None) -> None:
    """An empty Parquet table, if there is none of that name."""
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet "
              f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) {location} {_listed(settings)}")


def _listed(settings: dict[str, str] | None) -> str:
    quoted = lambda text: text.replace("\\", "\\\\").replace("'", "\\'")
    return f"TBLPROPERTIES ({', '.join(f"'{k}' = '{quoted(v)}'" for k, v in settings.items())})" if settings else ""


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, settings: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET {_listed(settings)}")


def table_location(spark: SparkSession, table: str) -> str:
    # Collected as it is: a filter on it would be a job.
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return described["Location"].rstrip("/")


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows for; the others stay."""
    # The setting, since a writer's own option does not reach insertInto.
    with _setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.mode("overwrite").insertInto(table)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unsorted_partitions(spark: SparkSession):
    """Within this, a task that writes partitions keeps their files open side by side. Otherwise it
    sorts all its rows by partition first, also where it has rows of one only."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "16")


#: Table property that holds the number of the newest batch.
_NEWEST = "feedworks.newest_batch"


def replace_batch(df: DataFrame, table: str, batch_id: int, path: str | None = None,
                  grow: bool = False) -> None:
    """Write a micro-batch into the partition ``batch_id`` of ``table``, creating
    the table before the first one. The last batch, repeated, replaces itself.
    ``grow`` as in :func:`fitted`."""
    spark = df.sparkSession
    batch_id = int(batch_id)
    # An empty table first: a crash in the first batch then leaves a table that
    # the repeated batch finds.
    create_table(spark, table, [*df.schema, T.StructField("batch_id", T.LongType())], ["batch_id"], path)
    check_batch(batch_id, newest_table_batch(spark, table), table)
    batch = fitted(df, table, but="batch_id", grow=grow)
    # The partition is named in the statement: a writer's own overwrite mode
    # does not reach insertInto, which would empty the whole table.
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {batch_id}) "
              "SELECT * FROM {batch}", batch=batch)
    set_properties(spark, table, {_NEWEST: str(batch_id)})


def drop_batch(spark: SparkSession, table: str, *batch_ids: int) -> None:
    """Take the partitions of batches out of ``table``. Its newest number stays."""
    listed = ", ".join(f"PARTITION (batch_id = {int(number)})" for number in batch_ids)
    if listed:
        folder = table_location(spark, table)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")
        for number in batch_ids:
            # Of a table at a path of its own the catalogue drops the entry only.
            delete(spark, f"{folder}/batch_id={int(number)}")


def newest_table_batch(spark: SparkSession, table: str) -> int | None:
    """The newest batch by the table's property; tables without it are looked through once."""
    noted = properties(spark, table)
    if _NEWEST in noted:
        return int(noted[_NEWEST])
    return (spark.sql(f"SHOW PARTITIONS {table}")
            .agg(F.max(F.regexp_extract("partition", r"batch_id=(\d+)", 1).cast("long"))).first()[0])

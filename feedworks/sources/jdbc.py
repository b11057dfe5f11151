"""Tables of a relational database."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def jdbc_options(url: str, table: str, *, driver: str | None = None,
                 user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower=None, upper=None,
                 num_partitions: int | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    """Reader options for a table scan, in ranges of ``partition_column`` if given."""
    ranges = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in ranges) and any(v is None for v in ranges):
        raise ValueError("partition_column, lower, upper and num_partitions go together")
    options = {
        "url": url, "dbtable": table, "driver": driver, "user": user,
        "password": password, "fetchsize": fetchsize,
        "partitionColumn": partition_column, "lowerBound": lower,
        "upperBound": upper, "numPartitions": num_partitions,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def balanced_predicates(values: DataFrame, column: str, parts: int, error: float = 0.001) -> list[str]:
    """Conditions on ``column`` for :func:`jdbc_table`, one per task, that split ``values`` about
    evenly wherever they lie, by approximate quantiles.

    ``values`` is the column itself, or a sample of it, with numbers. Every value meets exactly one
    condition, also one that the sample lacks; nulls go with the lowest. Where one value is more than a
    share of its own there are fewer conditions. The conditions are plain SQL.
    """
    if parts < 1:
        raise ValueError("at least one part is needed")
    shares = [i / parts for i in range(1, parts)]
    borders = sorted(set(values.approxQuantile(column, shares, error))) if shares else []
    whole = isinstance(values.schema[column].dataType, T.IntegralType)
    texts = [str(int(b)) if whole else repr(b) for b in borders]
    if not texts:
        return ["1 = 1"]
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in pairwise(texts)]
    return [f"{column} <= {texts[0]} OR {column} IS NULL", *between, f"{column} > {texts[-1]}"]


def jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, parts: int, **settings) -> DataFrame:
    """Scan ``table`` in about even ranges of ``column``, whose values are read once before, alone."""
    values = jdbc_table(spark, url, table, **settings).select(column)
    return jdbc_table(spark, url, table, balanced_predicates(values, column, parts), **settings)


def jdbc_table(spark: SparkSession, url: str, table: str,
               predicates: list[str] | None = None, **settings) -> DataFrame:
    """Scan ``table``; filters and column choices reach the database.

    Without further settings the scan is one task. ``partition_column`` with
    bounds reads equal ranges side by side; where values are unevenly spread
    pass ``predicates``, one disjoint condition per task, instead.
    """
    options = jdbc_options(url, table, **settings)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    if "partitionColumn" in options:
        raise ValueError("give either predicates or a partition column")
    for name in ("url", "dbtable"):
        options.pop(name)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)

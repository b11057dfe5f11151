"""Delimited text with a header; every column is a string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def delimited(spark: SparkSession, path: str, sep: str = ",",
              schema: T.StructType | str | None = None, header: bool = True,
              **options) -> DataFrame:
    """Read CSV or TSV files, one record per line.

    Lines are records, so one file is read in splits. Without ``schema`` the
    names come from the header, which costs a look at the first file only.
    """
    reader = spark.read.options(sep=sep, header=header, multiLine=False, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)

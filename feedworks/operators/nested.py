"""Reshaping of nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, fields: Mapping, root: str | None = None,
            keep: Sequence[str | Column] = (), typed: bool = True) -> DataFrame:
    """Select ``keep`` and the fields of a map.

    A map value is a path, a ``(path, type)`` pair, or a map of its own, which
    becomes a struct. Values that do not fit their type become null; without
    ``typed`` they are left as they come. A struct is there even when all its
    fields are null.
    """
    def build(spec) -> Column:
        if isinstance(spec, Mapping):
            return F.struct(*[build(s).alias(n) for n, s in spec.items()])
        path, type_ = (spec, None) if isinstance(spec, str) else spec
        value = F.col(f"{root}.{path}" if root else path)
        return value if not typed or type_ in (None, "string") else value.try_cast(type_)

    return df.select(*keep, *[build(s).alias(n) for n, s in fields.items()])


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Replace every struct column by its leaves, named ``parent_leaf``."""
    def leaves(column: Column, name: str, type_: T.DataType):
        if not isinstance(type_, T.StructType):
            yield column.alias(name)
            return
        for field in type_.fields:
            yield from leaves(column.getField(field.name), f"{name}{sep}{field.name}", field.dataType)

    columns = [c for f in df.schema.fields
               for c in leaves(F.col(f"`{f.name}`"), f.name, f.dataType)]
    flat = df.select(*columns)
    if len(set(flat.columns)) < len(flat.columns):
        raise ValueError(f"flattening gives a name twice: {flat.columns}")
    return flat


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns new names by position."""
    return df.toDF(*names)


def first_rows(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` rows: any, or the first in an order, which Spark finds with a
    top-n per partition rather than a sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

"""Comma-separated event messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.operators import nested
from feedworks.schema import CORRUPT, MESSAGE

_QUOTED = r'''"(?:[^"\\]|\\.|"")*"'''


def decode_csv(df: DataFrame, column: str = "value", schema: T.StructType = MESSAGE,
               sep: str = ",", quoting: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of the message in ``column``, in the order of ``schema``, behind the columns in ``keep``.

    Missing fields at the end are null. A message that does not fit, having
    more fields than ``schema`` or a quote that is not closed, is kept as a whole in
    ``_corrupt_record`` beside the fields it gives. With ``quoting`` a quoted field may hold
    the separator, and an empty field is null. Without it the text is cut at
    every separator, an empty field stays an empty string, and those at the end
    count as missing.
    """
    text = F.col(column).cast("string")
    literal = rf"\Q{sep}\E"
    bare = F.regexp_replace(text, f"(?:{literal})+$", "")
    # Quoted fields weigh nothing here; a quote left over was never closed.
    outside = F.regexp_replace(bare, _QUOTED, "") if quoting else bare
    unfit = F.size(F.split(outside, literal, -1)) > len(schema)
    if quoting:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        unfit = unfit | outside.rlike(rf'(?:^|{literal})\s*"')
        return df.select(*keep, F.from_csv(text, fields, {"sep": sep}).alias("_message"),
                         F.when(unfit, text).alias(CORRUPT)).select(*keep, "_message.*", CORRUPT)
    parts = (F.when((bare == "") & (text != ""), F.array().cast("array<string>"))
             .otherwise(F.split(bare, literal, -1)))
    return df.select(*keep, parts.alias("_parts"), F.when(unfit, text).alias(CORRUPT)).select(*keep, *[
        F.get("_parts", F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)], CORRUPT)


def project_ids(messages: DataFrame) -> DataFrame:
    """``network_id`` and ``event_id`` of decoded messages."""
    return nested.project(messages, {"network_id": "NETWORK_ID", "event_id": "EVENT_ID"})

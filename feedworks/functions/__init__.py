"""Column functions of the feed jobs, all built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks import schema

# One attribute of a start tag; the value may hold ">" or "/".
_ATTRIBUTE = r"""\s+[^\s=>/]+\s*=\s*(?:"[^"]*"|'[^']*')"""


def document_id(event_id: Column) -> Column:
    """Lower-case hex SHA-1 of the id as text; null for a null id."""
    return F.sha1(event_id.cast("string"))


def has_marker(text: Column, marker: str) -> Column:
    """True where ``text`` contains ``marker``, false for null."""
    return F.coalesce(text.cast("string").contains(marker), F.lit(False))


def is_subject_line(text: Column) -> Column:
    """True where the text holds a subject number such as ``3.`` or ``IV.``.

    The pattern matches anywhere: ``29. x`` qualifies through ``9.``, ``20. x``
    does not.
    """
    return F.coalesce(text.cast("string").rlike(schema.SUBJECT_PATTERN), F.lit(False))


def row_json(df: DataFrame) -> Column:
    """The whole row of ``df`` as one JSON object."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` refers to it: also
    within lambdas and generators, where Spark shares no parts between expressions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def start_tag(fragment: Column, tag: str) -> Column:
    """The start tag ``fragment`` begins with, or an empty string."""
    return F.regexp_extract(fragment, rf"^<{tag}(?:{_ATTRIBUTE})*\s*/?>", 0)


def tag_pieces(text: Column, *tags: str) -> Column:
    """``text`` cut before every start tag of ``tags``. Array of strings in text
    order; the first is what precedes the first start tag."""
    if len(tags) == 1:
        # The pattern starts with a fixed text, which Java looks for in leaps.
        opening = f"<{tags[0]}"
        pieces = F.split(text, rf"{opening}(?=[\s/>])", -1)
        return F.transform(pieces, lambda p, i: F.when(i > 0, F.concat(F.lit(opening), p)).otherwise(p))
    pieces = F.split(text, rf"<(?=(?:{'|'.join(tags)})[\s/>])", -1)
    return F.transform(pieces, lambda p, i: F.when(i > 0, F.concat(F.lit("<"), p)).otherwise(p))


def cut_at_end(piece: Column, tag: str) -> Column:
    """``piece`` before and after its first end tag."""
    return F.split(piece, rf"</{tag}\s*>", 2)


def stray(text: Column, tag: str) -> Column:
    """``text`` in an array if it holds an end tag, which no start tag claims;
    else an empty array. Text between elements holds none."""
    return F.when(F.size(cut_at_end(text, tag)) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))


def element_text(piece: Column, tag: str) -> Column:
    """``piece`` up to the end tag of the element it begins with.

    A piece without an end tag was cut off; it is returned whole, so that
    parsing reports it as corrupt.
    """
    parts = cut_at_end(piece, tag)
    return F.when(F.size(parts) > 1, F.concat(F.get(parts, F.lit(0)), F.lit(f"</{tag}>"))).otherwise(piece)


def fragments_of(piece: Column, tag: str) -> Column:
    """The element that ``piece`` begins with, and what is stray behind it.

    A self-closing element holds no data and is left out.
    """
    opening = start_tag(piece, tag)
    behind = F.substring(piece, F.char_length(opening) + 1, F.char_length(piece))
    rest = F.coalesce(F.get(cut_at_end(piece, tag), F.lit(1)), F.lit(""))
    return (F.when(opening.endswith("/>"), stray(behind, tag))
            .otherwise(F.concat(F.array(element_text(piece, tag)), stray(rest, tag))))


def xml_fragments(text: Column, tag: str) -> Column:
    """The ``tag`` elements of ``text`` as an array of XML strings.

    Self-closing elements hold no data and are left out. An element cut off by
    the next start tag is returned as its own, unparsable fragment, and does not
    take its neighbour with it. Text with an end tag that no start tag claims is
    returned as a fragment that does not begin with ``<tag``.
    """
    return F.flatten(F.transform(tag_pieces(text, tag), lambda p, i: F.when(
        i > 0, fragments_of(p, tag)).otherwise(stray(p, tag))))

"""Personal data: rules, and contexts learned from what the rules find.

Rules find e-mail addresses, IP addresses, card and phone numbers. What they find are
the seeds of a bootstrap. A pattern is the kind of a seed with the words beside it: one or two words
before it, the words before and after, or the word after. A label glued to a value by a colon
or an equals sign is the word before it. Candidates are the other words with a digit or an at sign, and
groups of digits that stand together, up to :data:`GROUPS` words. Patterns and candidates
form a graph, scored in rounds:

* a pattern's confidence is the mean confidence of what stands in it, counted with
  :data:`DOUBT` unknown occurrences more; a seed counts 1, a candidate its own;
* a candidate's confidence is that of its best pattern.

A candidate starts at 0. Patterns that end at :data:`CONFIDENT` or above, with seeds of
:data:`LEAST_SEEDS` distinct values, are trusted, and the candidates in them are spans of kind
``near_<kind>``. Their values are then seeds in turn, of all patterns that they stand in, until
no further value is found.

Occurrences are counted per pattern and value before the rounds, so a pattern
or value may hold any share of the rows.

Defined results: null text is empty and has no spans; equal rows are scanned each; no
rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import AT, FILE, ROW, in_small_batches, numbered, on_file, text_of

KINDS = ("email", "ip", "card", "phone")
#: Rounds over the graph, and what a pattern needs.
ROUNDS, DOUBT, CONFIDENT, LEAST_SEEDS = 4, 1.0, 0.7, 5
#: Words of one candidate at most: a longer row of numbers is a table, and its words stand alone.
GROUPS = 4

#: What may stand before the ``@`` of an address, and behind it.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED, _NUMBER = re.compile(r"[0-9]+(?:\.[0-9]+)*"), re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_EDGES = "\"'.,;:!?()[]{}<>$%&#*"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of addresses, from each ``@`` outwards: a search from the left would begin anew at
    every letter of a long run without one."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Spans of four numbers with dots between them, four after four in a longer row."""
    for row in _DOTTED.finditer(text):
        if row.group().count(".") < 3:
            continue
        numbers = [m.span() for m in _NUMBER.finditer(text, *row.span())]
        for i in range(0, len(numbers) - 3, 4):
            yield numbers[i][0], numbers[i + 3][1]


def _is_ip(match: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in match.split("."))


def _digits(match: str) -> str:
    return "".join(_DIGIT.findall(match))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans that the rules find: number of the kind, start, end."""
    spans = [(0, *span) for span in _emails(text)]
    if _DIGIT.search(text):
        spans += [(1, *span) for span in _ips(text) if _is_ip(text[slice(*span)])]
        spans += [(2, *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return spans


def _clean(word: str) -> str:
    return word.strip(_EDGES).lower()


def _contexts(before: list[str], after: list[str]) -> list[str]:
    """Patterns of a place: up to four ways to look at the words beside it."""
    found = []
    if after and after[0]:
        found.append(f"_ {after[0]}")
    if before and before[-1]:
        found.append(f"{before[-1]} _")
        if len(before) > 1 and before[-2]:
            found.append(f"{before[-2]} {before[-1]} _")
        if after and after[0]:
            found.append(f"{before[-1]} _ {after[0]}")
    return found


def _candidates(text: str, words: list[tuple[int, int]], covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places of words, or of groups of digits, that might be identifiers, beside the covered ones."""
    places, rows, at = [], [], 0
    for number, (start, end) in enumerate(words):
        value = text[start:end]
        if not _DIGIT.search(value) and "@" not in value:
            continue
        bare = value.rstrip(_EDGES)
        end -= len(value) - len(bare)
        cut = max(bare.rfind(":"), bare.rfind("=")) + 1
        glued, start = cut > 0, start + cut
        start += len(bare) - cut - len(bare[cut:].lstrip(_EDGES))
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        value = text[start:end]
        if start >= end or any(s < end and start < e for s, e in covered[at:at + 4]) or not (_DIGIT.search(value) or "@" in value):
            continue
        row = rows[-1] if rows else None
        joins = (row and row[-1][0] == number - 1 and not glued and "@" not in value and "@" not in text[slice(*row[-1][1:])]
                 and not text[row[-1][2]:start].strip("() \t\n\r\v\f"))
        if joins:
            row.append((number, start, end))
        else:
            rows.append([(number, start, end)])
    for row in rows:
        places += [(row[0][1], row[-1][2])] if len(row) <= GROUPS else [place[1:] for place in row]
    return places


def occurrences(text: str) -> list[tuple[int, int, int, str, list[str]]]:
    """Seeds and candidates of a text: kind or -1, start, end, value, patterns."""
    base = base_spans(text)
    if not base and not _DIGIT.search(text) and "@" not in text:
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    covered = sorted((start, end) for _, start, end in base)
    places = base + [(-1, *place) for place in _candidates(text, words, covered)]
    starts = [start for start, _ in words]
    out = []
    for kind, start, end in places:
        first = _at_or_before(starts, start)
        last = _at_or_before(starts, end - 1)
        before = [_clean(text[s:e]) for s, e in words[max(0, first - 2):first]]
        label = _clean(text[words[first][0]:start].rstrip("=" + _EDGES))
        after = [_clean(text[s:e]) for s, e in words[last + 1:last + 2]]
        out.append((kind, start, end, text[start:end].lower(), _contexts(before + [label] if label else before, after)))
    return out


def _at_or_before(starts: list[int], place: int) -> int:
    return bisect.bisect_right(starts, place) - 1


_FOUND = pa.schema([(FILE, pa.int64()), (AT, pa.int64()), ("kind", pa.int32()), ("start", pa.int64()),
                    ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for file, at, text in zip(batch[FILE].to_pylist(), batch[AT].to_pylist(), batch["text"], strict=True):
            rows += [(file, at, *found) for found in occurrences(text.as_py())]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND)


def scan(docs: DataFrame) -> DataFrame:
    """Seeds (kind 0 and above) and candidates (-1) with their places and patterns; written."""
    schema = f"{FILE} long, {AT} long, kind int, start long, end long, value string, patterns array<string>"
    docs = in_small_batches(docs)
    return workspace.materialise(numbered(docs, text_of(docs)).mapInArrow(_scan, schema), "pii_found")


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns that name a kind: pattern, kind, confidence; written."""
    stands = workspace.materialise(
        found.select("kind", "value", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "kind", "value").agg(F.count("*").alias("times")), "pii_graph")
    seeds, candidates = stands.filter("kind >= 0"), stands.filter("kind < 0").drop("kind")
    trusted, count = None, 0
    while True:
        if trusted is not None:
            seeds = stands.filter("kind >= 0").unionByName(candidates.join(trusted, "value"))
        patterns = _scored(stands, seeds, candidates, rounds)
        values = (candidates.join(patterns.select("pattern", "kind", "confidence"), "pattern")
                  .groupBy("value").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("order"))).alias("best"))
                  .select("value", (-F.col("best.order")).alias("kind")))
        if trusted is not None:
            # A value keeps the kind that it was trusted as, so that values only become more.
            values = trusted.unionByName(values.join(trusted, "value", "left_anti"))
        trusted = workspace.materialise(values, "pii_trusted")
        before, count = count, trusted.count()
        if count == before:
            return patterns


def _scored(stands: DataFrame, seeds: DataFrame, candidates: DataFrame, rounds: int) -> DataFrame:
    """The patterns that pass with these seeds, each with its likeliest kind; written."""
    enough = (seeds.groupBy("pattern", "kind").agg(F.count("*").alias("values"), F.sum("times").alias("seeds"))
              .filter(f"values >= {LEAST_SEEDS}"))
    other = (stands.groupBy("pattern").agg(F.sum("times").alias("times"))
             .join(enough, "pattern").select("pattern", "kind", "seeds", "times"))
    patterns = workspace.materialise(
        other.withColumn("confidence", F.col("seeds") / (F.col("times") + DOUBT)), "pii_patterns")
    # What is a seed counts as such already.
    seeded = seeds.select("pattern", "value", "kind")
    edges = workspace.materialise(
        candidates.withColumnRenamed("times", "edge_times").join(patterns.select("pattern", "kind"), "pattern")
        .join(seeded, ["pattern", "value", "kind"], "left_anti"), "pii_edges")
    for _ in range(rounds):
        values = (edges.join(patterns.select("pattern", "kind", "confidence"), ["pattern", "kind"])
                  .groupBy("value", "kind").agg(F.max("confidence").alias("trust")))
        gained = (edges.join(values, ["value", "kind"])
                  .groupBy("pattern", "kind").agg(F.sum(F.col("trust") * F.col("edge_times")).alias("gained")))
        patterns = workspace.materialise(
            patterns.drop("confidence").join(gained, ["pattern", "kind"], "left")
            .withColumn("confidence", (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("times") + DOUBT))
            .drop("gained"), "pii_patterns")
    best = Window.partitionBy("pattern").orderBy(F.desc("confidence"), "kind")
    return workspace.materialise(
        patterns.filter(F.col("confidence") >= CONFIDENT).withColumn("rank", F.row_number().over(best))
        .filter("rank = 1").select("pattern", "kind", "confidence"), "pii_confident")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: row identity, doc_id and ``spans``, an array of (kind, start, end) in that
    order; kinds from ``len(KINDS)`` on were found by context."""
    docs = on_file(docs)
    found = scan(docs)
    patterns = confident_patterns(found)
    added = (found.filter("kind < 0").select(*ROW, "start", "end", F.explode("patterns").alias("pattern"))
             .join(patterns.withColumnRenamed("kind", "named"), "pattern")
             .groupBy(*ROW, "start", "end").agg(F.max(F.struct("confidence", (-F.col("named")).alias("order"))).alias("best"))
             .select(*ROW, "start", "end", (F.lit(len(KINDS)) - F.col("best.order")).cast("int").alias("kind")))
    every = found.filter("kind >= 0").select(*ROW, "start", "end", "kind").unionByName(added)
    spans = every.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return (numbered(docs, docs["doc_id"].alias("doc_id")).join(spans, ROW, "left")
            .withColumn("spans", F.coalesce("spans", none)))

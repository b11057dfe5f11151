"""Secret scans: rules, and character Markov models for what no rule names.

Rules find assignments, access keys and long hex strings. Beside them every long
run of identifier characters is scored by two first-order Markov models of
characters, one of random strings and one of ordinary identifiers: the sum over its
character pairs of log P(pair | random) - log P(pair | ordinary). Runs above
:data:`LEAST_RATIO` are spans of kind ``markov`` unless they have no letter, as card and
account numbers, or a rule's span overlaps them.

The models are trained on labelled samples from a bounded number of documents: strings that the
rules find are labelled random, other runs that occur in several texts ordinary. The random model is mixed half
and half with uniform characters; the ordinary model falls back on single characters.

All steps are DataFrame functions. Places are counted in code points: a text is cut at
its matches, and lengths are added up along them.

Defined results: null text is empty and has no spans; equal rows are scanned each; no
rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedworks.llm.rows import ROW, hash_bound, numbered, sampled, text_of

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in order of listing. Access keys and hex strings too short to pass are left out
#: by the pattern itself, since no longer match can begin within a shorter one.
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}",
            "markov": r"[A-Za-z0-9+/_=-]{16,}"}
KINDS = tuple(PATTERNS)
LEAST_ASSIGNED = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Documents that the models are trained on, about; all where there are fewer.
TRAINING_ROWS = 4000
#: Log-likelihood ratio of a random string, and distinct characters it must have.
LEAST_RATIO, LEAST_DISTINCT = 15.0, 8
#: Weight of single characters in the ordinary model, and of an unseen character.
_BACKOFF, _UNSEEN = 5.0, 0.01
_SHORTEST_SAMPLE = 6


def _with_gaps(kind: str) -> Column:
    """The matches of a kind: number of the kind, place among them, characters between
    the match and the one before, value."""
    gaps = F.when(F.size(kind) > 0, F.split("text", PATTERNS[kind], -1))
    listed = F.transform(kind, lambda value, at: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), at.alias("at"), F.lit(0).alias("gap"), value.alias("value")))
    return F.zip_with(listed, F.transform(F.slice(F.coalesce(gaps, F.array().cast("array<string>")), F.lit(1), F.size(kind)), F.char_length),
                      lambda match, gap: match.withField("gap", gap))


def matches(rows: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Matches in ``rows`` (row identity and text): row identity, kind (its number), start, end, value."""
    found = rows.select(*ROW, "text", *[F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)).alias(k) for k in kinds])
    found = found.filter(" or ".join(f"size({k}) > 0" for k in kinds))
    each = (found.select(*ROW, F.explode(F.concat(*map(_with_gaps, kinds))).alias("each"))
            .select(*ROW, "each.*").repartition(*ROW))
    along = Window.partitionBy(*ROW, "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("value")
    end = F.sum(F.col("gap") + length).over(along)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - length)
    return placed.select(*ROW, "kind", "start", "end", "value")


def passing(found: DataFrame) -> DataFrame:
    """Without assignments of values that are too short."""
    assigned = F.char_length(F.regexp_extract("value", ASSIGN, 2))
    return found.filter((F.col("kind") != 0) | (assigned >= LEAST_ASSIGNED))


def log_ratios(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> list[float]:
    """For each pair of characters of :data:`ALPHABET`, log P(random) - log P(ordinary)."""
    bound = hash_bound(training_rows, docs.count())
    text = text_of(docs)
    chosen = sampled(F.xxhash64(docs["doc_id"].cast("string"), F.char_length(text)), bound)
    sample = docs.select(text).filter(chosen)
    random = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
                      *[F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0)) for k in ("access", "hex")])
    rest = F.col("text")
    for kind in ("assign", "access", "hex"):
        rest = F.regexp_replace(rest, PATTERNS[kind], " ")
    ordinary = F.regexp_extract_all(rest, F.lit("[A-Za-z0-9+/_=-]{%d,}" % _SHORTEST_SAMPLE), F.lit(0))
    text_key = F.xxhash64("text").alias("in_text")
    strings = (sample.select(F.lit(True).alias("random"), text_key, F.explode(random).alias("value"))
               .unionAll(sample.select(F.lit(False).alias("random"), text_key, F.explode(ordinary).alias("value")))
               .filter(F.char_length("value") >= _SHORTEST_SAMPLE).distinct()
               .groupBy("random", "value").agg(F.count("*").alias("texts")).filter("random or texts > 1"))
    codes = _codes(F.col("value"))
    pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                       lambda one, other: F.struct(one.alias("one"), other.alias("other")))
    counts = (strings.select("random", "texts", F.explode(pairs).alias("pair")).select("random", "texts", "pair.*")
              .filter("one > 0 and other > 0").groupBy("random", "one", "other").agg(F.sum("texts").alias("times")).collect())
    if not counts and training_rows and sample.isEmpty() and not docs.isEmpty():
        raise RuntimeError("no documents drawn to train on")
    return _ratios({(r["random"], r["one"] - 1, r["other"] - 1): r["times"] for r in counts})


def _ratios(counts: dict[tuple[bool, int, int], int]) -> list[float]:
    size = len(ALPHABET)
    after = {(kind, one): sum(counts.get((kind, one, other), 0) for other in range(size))
             for kind in (True, False) for one in range(size)}
    single = [sum(counts.get((False, one, other), 0) for one in range(size)) + _UNSEEN for other in range(size)]
    total = sum(single)
    out = []
    for one in range(size):
        for other in range(size):
            seen = counts.get((True, one, other), 0) / after[True, one] if after[True, one] else 1 / size
            random = 0.5 * seen + 0.5 / size
            ordinary = ((counts.get((False, one, other), 0) + _BACKOFF * single[other] / total)
                        / (after[False, one] + _BACKOFF))
            out.append(math.log(random) - math.log(ordinary))
    return out


def _codes(value: Column) -> Column:
    """The place of each character in the alphabet, 0 for others."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def ratio(value: Column, ratios: list[float]) -> Column:
    """The log-likelihood ratio of a string of alphabet characters."""
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    codes, size = _codes(value), len(ALPHABET)
    steps = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                       lambda one, other: F.get(table, (one - 1) * size + other - 1))
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)


def secrets(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Per document: row identity, doc_id and ``spans``, an array of (start, kind, end)
    by start and then kind (its number in :data:`KINDS`)."""
    ratios = log_ratios(docs, training_rows)
    markov = KINDS.index("markov")
    rows = numbered(docs, text_of(docs))
    random = (F.col("value").rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split("value", ""))) >= LEAST_DISTINCT)
              & (ratio(F.col("value"), ratios) >= LEAST_RATIO))
    found = passing(matches(rows)).filter((F.col("kind") != markov) | random)
    spans = found.groupBy(*ROW).agg(F.collect_list(F.struct("start", "kind", "end")).alias("spans"))
    base = F.filter("spans", lambda span: span["kind"] != markov)
    added = F.filter("spans", lambda span: (span["kind"] == markov) & ~F.exists(
        base, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"])))
    spans = spans.select(*ROW, F.array_sort(F.concat(base, added)).alias("spans"))
    ids = numbered(docs, docs["doc_id"].alias("doc_id"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return ids.join(spans, ROW, "left").withColumn("spans", F.coalesce("spans", none))

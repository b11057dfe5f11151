"""Language of web pages by Bayesian fusion of evidence.

The chance of a language given a page is proportional to

    P(text | language) * P(declared | language) * P(suffix | language) * P(language | host)

* text: byte trigrams of the visible text, by a multinomial model of each language
  trained on documents of every known language. Trigrams overlap and repeat, so a text's
  evidence counts as that of at most :data:`TEXT_EVIDENCE` of them.
* declared: the ``lang`` attribute of the markup; suffix: the last label of the host.
  How often each goes with a language is counted over all pages.
* host: pages of a host share languages. The prior of a host is its other pages' share,
  smoothed by that of its domain, and that by the share of all pages.

The counts are soft: a page counts for each language as much as its text alone says. They
are grouped aggregations, added up before the shuffle; a page's own part is taken off its
host's and its domain's.

Defined results: null and empty pages have no text evidence; a missing url, host or ``lang``
is a value of its own; equal rows are judged each; without documents of known language
every page has a null language; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import broadcast_if_small, hash_bound, in_small_batches, sampled, text_of

#: Documents of each language that the text model is trained on, about; all where there are fewer.
TRAINING_ROWS = 4000
#: Hashed trigrams, their smoothing, and the weight of a text.
BINS, SMOOTHING, TEXT_EVIDENCE = 1 << 14, 0.5, 100.0
#: Weight of the next level in a prior, and of the share of all pages in other evidence.
HOST_WEIGHT, DOMAIN_WEIGHT, OTHER_WEIGHT = 4.0, 4.0, 4.0

_DROPPED = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)", re.I | re.S)
_TAG = re.compile(r"<[^<>]*>")
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def visible_text(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _DROPPED.sub(" ", page)))


def trigrams(text: str) -> np.ndarray:
    """Bins of the byte trigrams of a text, case and white space levelled."""
    data = np.frombuffer(" ".join(text.lower().split()).encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    value = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return ((value * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def train(docs: DataFrame, training_rows: int = TRAINING_ROWS) -> tuple[list[str], np.ndarray]:
    """The languages, and the log chance of each trigram bin in each."""
    docs = in_small_batches(docs)
    known = docs.select(docs["lang"].cast("string").alias("lang"), text_of(docs), docs["doc_id"].alias("id")).filter("lang is not null")
    held = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    languages = sorted(held)
    place = {lang: i for i, lang in enumerate(languages)}
    bounds = docs.sparkSession.createDataFrame(
        [(lang, place[lang], hash_bound(training_rows, held[lang])) for lang in languages], "lang string, place int, bound long")
    sample = known.join(F.broadcast(bounds), "lang").filter(sampled(F.xxhash64("id", "text", F.lit(3)), F.col("bound")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[int, np.ndarray] = {}
            texts: dict[int, int] = {}
            for number, text in zip(batch["place"].to_pylist(), batch["text"], strict=True):
                totals[number] = totals.get(number, 0) + np.bincount(trigrams(text.as_py()), minlength=BINS)
                texts[number] = texts.get(number, 0) + 1
            for number, total in totals.items():
                # After the bins used, one beyond them counts the texts.
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used) + 1, number), pa.int32()), pa.array(np.append(used, BINS), pa.int32()),
                     pa.array(np.append(total[used], texts[number]), pa.int64())], names=["place", "bin", "times"])

    counts = np.zeros((len(languages), BINS + 1))
    rows = (sample.select("place", "text").mapInArrow(counted, "place int, bin int, times long")
            .groupBy("place", "bin").agg(F.sum("times").alias("times")).toArrow())
    counts[rows["place"].to_numpy(), rows["bin"].to_numpy()] = rows["times"].to_numpy()
    missing = [lang for lang in languages if not counts[place[lang], BINS]]
    if missing and training_rows:
        raise RuntimeError(f"no documents drawn to train on in {missing}")
    counts = counts[:, :BINS] + SMOOTHING
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts


def _page_evidence(pages: DataFrame, log_chance: np.ndarray) -> DataFrame:
    """Per page its id, host, domain, suffix, declared language, and the chance of each
    language by the text alone; written."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, page in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"], strict=True):
                page = page.as_py()
                bins = trigrams(visible_text(page))
                evidence = log_chance[:, bins].sum(axis=1) * (TEXT_EVIDENCE / (len(bins) + TEXT_EVIDENCE))
                chance = np.exp(evidence - evidence.max())
                declared, host = _LANG.search(page), _HOST.search(url)
                labels = host.group(1).lower().strip(".").split(".") if host else [""]
                rows.append((page_id, ".".join(labels), ".".join(labels[-3:] if len(labels) > 3 else labels[-2:]), labels[-1],
                             declared.group(1).lower() if declared else "", (chance / chance.sum()).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=["page_id", "host", "domain", "suffix", "declared", "by_text"])

    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
    read = pages.select(pages["page_id"].cast("long").alias("page_id"),
                        F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"),
                        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    schema = "page_id long, host string, domain string, suffix string, declared string, by_text array<double>"
    return workspace.materialise(read.mapInArrow(judged, schema), "page_evidence")


def _soft_counts(rows: DataFrame, key: str | None, column: str, n: int, name: str) -> DataFrame:
    """Sums of an array of ``n`` chances by ``key``, as an array ``name``."""
    sums = [F.sum(F.get(column, F.lit(i))).alias(f"s{i}") for i in range(n)]
    grouped = rows.groupBy(key) if key else rows.groupBy()
    return grouped.agg(*sums).select(*([key] if key else []), F.array(*[f"s{i}" for i in range(n)]).alias(name))


def _less(one: Column, other: Column) -> Column:
    return F.zip_with(one, other, lambda x, y: F.greatest(x - y, F.lit(0.0)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _smoothed(counts: Column, prior: Column, weight: float) -> Column:
    return F.zip_with(counts, prior, lambda n, p: (n + weight * p) / (_total(counts) + weight))


def page_languages(pages: DataFrame, docs: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Per page: page_id, lang and its probability, text_lang (by the text alone), declared, host."""
    languages, log_chance = train(docs, training_rows)
    if not languages:
        unknown = F.lit(None).cast("string")
        return pages.select(pages["page_id"].cast("long").alias("page_id"), unknown.alias("lang"),
                            F.lit(None).cast("double").alias("probability"), unknown.alias("text_lang"),
                            F.lit("").alias("declared"), F.lit("").alias("host"))
    n = len(languages)
    rows = _page_evidence(pages, log_chance)
    hosts = workspace.materialise(
        rows.groupBy("host", "domain").agg(*[F.sum(F.get("by_text", F.lit(i))).alias(f"s{i}") for i in range(n)])
        .select("host", "domain", F.array(*[f"s{i}" for i in range(n)]).alias("by_host")), "hosts")
    domains = workspace.materialise(_soft_counts(hosts, "domain", "by_host", n, "by_domain"), "domains")
    all_pages = _soft_counts(domains, None, "by_domain", n, "counts").first()["counts"]
    total = sum(x or 0.0 for x in all_pages)
    share = [((x or 0.0) + 1.0) / (total + n) for x in all_pages]
    shares = F.array(*map(F.lit, share))

    found = rows.join(broadcast_if_small(hosts.drop("domain")), "host").join(broadcast_if_small(domains), "domain")
    domain_prior = _smoothed(_less(F.col("by_domain"), F.col("by_text")), shares, DOMAIN_WEIGHT)
    found = found.withColumn("domain_prior", domain_prior)
    found = found.withColumn("prior", _smoothed(_less(F.col("by_host"), F.col("by_text")), F.col("domain_prior"), HOST_WEIGHT))
    weighed = F.zip_with(F.transform("by_text", lambda p: F.log(p + 1e-300)), F.col("prior"), lambda t, p: t + F.log(p))
    for key in ("declared", "suffix"):
        counts = workspace.materialise(_soft_counts(rows, key, "by_text", n, f"with_{key}"), key)
        found = found.join(broadcast_if_small(counts), key)
        # P(value | language) is P(language | value) / P(language) but for a constant.
        given = _smoothed(F.col(f"with_{key}"), shares, OTHER_WEIGHT)
        weighed = F.zip_with(weighed, F.zip_with(given, shares, lambda g, s: F.log(g / s)), lambda w, e: w + e)
    names = F.array(*map(F.lit, languages))
    found = found.withColumn("weighed", weighed).withColumn("best", F.array_max("weighed"))
    chances = F.transform("weighed", lambda w: F.exp(w - F.col("best")))
    return found.select(
        "page_id", F.get(names, F.array_position("weighed", F.col("best")).cast("int") - 1).alias("lang"),
        (1 / _total(chances)).alias("probability"),
        F.get(names, F.array_position("by_text", F.array_max("by_text")).cast("int") - 1).alias("text_lang"),
        "declared", "host")

"""Toxicity by non-negative positive-unlabelled learning.

A linear model is trained from confirmed toxic documents and from documents of
which nothing is known. With p the share of toxic documents, the risk is

    p * E_toxic[loss(score)] + max(0, E_unlabelled[loss(-score)] - p * E_toxic[loss(-score)])

The second part is the risk on clean documents: that of all documents without what
the toxic ones among them add. It can't be negative; where a batch makes it so, the
model has begun to learn single documents by heart, and the step goes back.

A document is the set of its words and of their beginnings, hashed; words are cut
at white space and punctuation, so one text yields one score whatever its length.
Training takes a bounded sample to the driver (:data:`TOXIC_ROWS`,
:data:`UNLABELLED_ROWS`); scoring reads every whole text, without a shuffle.

Defined results: null and empty texts have no features and get the score of the
model's constant; a null doc_id has no label and is not held out; if a document has several labels the
highest counts; without toxic labels to learn from all scores are 0; equal texts
get equal scores; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.llm.rows import hash_bound, in_small_batches, sampled, text_of
from feedworks.llm.wordhash import PUNCTUATION, Words, chunks

THRESHOLD = 0.7
#: About so many rows are taken to train from; all of them where there are fewer.
TOXIC_ROWS, UNLABELLED_ROWS = 3000, 6000
#: Hash bits of a feature, and the bytes of the beginnings that are features too.
BITS, BEGINNINGS = 18, (4, 5)
#: Least toxic documents of the sample that a feature has to occur in.
LEAST_TOXIC = 4
#: How far its share in toxic documents has to stand out.
DEVIATIONS = 3.0
STEPS, RATE, DECAY = 300, 0.1, 3e-5


def feature_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct features of a chunk, ordered by row."""
    words = Words(data, offsets, PUNCTUATION)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    rows, hashes = [row], [words.hashes()]
    for length in BEGINNINGS:
        longer = words.end - words.start > length
        start = words.start[longer]
        rows.append(row[longer])
        hashes.append(words.hashes(start, start + length) + np.uint64(length))
    short = np.concatenate(hashes) >> np.uint64(64 - BITS)
    both = np.unique((np.concatenate(rows).astype(np.uint64) << np.uint64(BITS)) | short)
    return (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    constant: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for first, last, data, offsets in chunks(texts):
            row, feature = feature_sets(data, offsets)
            out[first:last] = np.bincount(row, self.weights[feature], last - first)
        return 1 / (1 + np.exp(-np.clip(out + self.constant, -500, 500)))

    def score(self, text: Column) -> Column:
        """The score of a text column."""
        @F.pandas_udf(T.DoubleType())
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.scores(pa.array(batch, pa.large_string(), from_pandas=True)))

        return scored(text)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """The model, from labels outside the held-out rows and unlabelled documents outside them."""
    docs = in_small_batches(docs)
    known = (labels.filter(labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
             .groupBy(labels["doc_id"].cast("long").alias("id")).agg(F.max(labels["toxic"].cast("int")).alias("toxic"))
             .filter("toxic is not null"))
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return Model(np.zeros(1 << BITS), -500.0)
    ids = docs.select(docs["doc_id"].cast("long").alias("id")).filter(~held_out(F.col("id")))
    n_rows = ids.count()

    def drawn(rows: int, count: int) -> Column:
        return sampled(F.xxhash64("id", F.lit(7)), hash_bound(rows, count))

    toxic = known.filter((F.col("toxic") == 1) & drawn(toxic_rows, n_toxic)).select("id", F.lit(True).alias("toxic"))
    sample = (docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs))
              .filter(F.coalesce(~held_out(F.col("id")), F.lit(True))).join(F.broadcast(toxic), "id", "left")
              .withColumn("unlabelled", drawn(unlabelled_rows, n_rows))
              .filter("toxic or unlabelled")
              .select(F.coalesce("toxic", F.lit(False)).alias("toxic"), F.coalesce("unlabelled", F.lit(False)).alias("unlabelled"), "text"))
    rows = sample.mapInArrow(_features, "toxic boolean, unlabelled boolean, features array<int>").toArrow()
    if rows.num_rows and not any(rows["unlabelled"].to_pylist()):
        raise RuntimeError("no documents drawn to train on beside the toxic ones")
    if not any(rows["toxic"].to_pylist()) and toxic.isEmpty():
        raise RuntimeError("no toxic documents drawn to train on")
    return fit(rows["features"].combine_chunks(), rows["toxic"].to_numpy(), rows["unlabelled"].to_numpy(), n_toxic / n_known)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch["text"]):
            row, feature = feature_sets(data, offsets)
            starts = np.searchsorted(row, np.arange(last - first + 1))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(feature, pa.int32()))
            own = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([own["toxic"], own["unlabelled"], lists],
                                             names=["toxic", "unlabelled", "features"])


def fit(features: pa.ListArray, toxic: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Trains on rows of feature numbers by Adam on the whole sample."""
    model = Model(np.zeros(1 << BITS), -500.0)
    if not len(toxic) or not toxic.any():
        return model
    number = np.asarray(features.flatten())
    row = np.repeat(np.arange(len(toxic)), np.asarray(features.value_lengths()))
    often = telling(number, row, toxic, unlabelled)
    used = np.flatnonzero(often)
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    keep = often[number]
    row, column = row[keep], place[number[keep]]

    to_toxic = prior * toxic / toxic.sum()
    to_all = unlabelled / max(1, unlabelled.sum())
    weights, first, second = (np.zeros(len(used) + 1) for _ in range(3))
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights[:-1][column], len(toxic)) + weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        clean_risk = np.logaddexp(0, score) @ (to_all - to_toxic)
        # The slope of the loss of calling a row toxic is chance - 1, of calling it clean, chance.
        slope = to_toxic * (chance - 1) + (to_all - to_toxic) * chance
        if clean_risk < 0:
            slope = -(to_all - to_toxic) * chance
        gradient = np.append(np.bincount(column, slope[row], len(used)), slope.sum())
        gradient[:-1] += DECAY * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        weights -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights[used] = weights[:-1]
    model.constant = float(weights[-1])
    return model


def telling(number: np.ndarray, row: np.ndarray, toxic: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """The features that toxic documents have more often than documents at large, by
    :data:`DEVIATIONS` standard deviations of such a difference."""
    n_toxic, n_all = int(toxic.sum()), max(1, int(unlabelled.sum()))
    in_toxic = np.bincount(number[toxic[row]], minlength=1 << BITS)
    in_all = np.bincount(number[unlabelled[row]], minlength=1 << BITS)
    share = np.clip((in_toxic + in_all) / (n_toxic + n_all), 1e-9, 1 - 1e-9)
    spread = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_all))
    return (in_toxic >= min(LEAST_TOXIC, n_toxic)) & (in_toxic / n_toxic - in_all / n_all >= DEVIATIONS * spread)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted."""
    model = train(docs, labels)
    scored = docs.select(docs["doc_id"].alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"),
                         model.score(text_of(docs)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

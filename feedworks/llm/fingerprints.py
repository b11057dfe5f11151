"""Document fingerprints from closed syncmers.

A k-mer of characters is an anchor if the smallest of its s-mers, by hash, is its first or
last. That depends on the k-mer alone, so an anchor survives any change outside it, and text
that two documents share gives them the same anchors wherever it stands. The fingerprint
holds every anchor with its position, in order of position, and so grows with its text by
about two anchors in ``K - S + 1`` characters. Two fingerprints are compared by position: anchors
of the same hash count as far as they come in the same order in both texts.

Defined results: null text is empty; an empty text has an empty fingerprint, like that of
an empty text only; a text without anchors is one anchor as a whole; equal texts have
equal fingerprints; no rows give no rows.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks import workspace
from feedworks.llm.rows import hash_bound, in_small_batches, sampled, text_of
from feedworks.llm.wordhash import mix

K, S = 16, 6
#: Rows aimed at in a block of neighbours, the most blocks, and sampled rows per block.
_BLOCK_ROWS, _MOST_BLOCKS, _SAMPLED = 256, 1 << 16, 20
#: Characters hashed at once.
_CHARS = 1 << 20


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of all anchors of a text, by place."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    found = [_anchors_of(codes[low:low + _CHARS + k - 1], k, s, low) for low in range(0, max(1, len(codes) - k + 1), _CHARS)]
    hashes = np.concatenate([f[0] for f in found])
    places = np.concatenate([f[1] for f in found])
    if not len(hashes) and len(codes):
        whole = int.from_bytes(hashlib.blake2b(codes.tobytes(), digest_size=4).digest(), "big")
        return np.array([whole], np.uint64), np.zeros(1, np.int64)
    return hashes, places


def _anchors_of(codes: np.ndarray, k: int, s: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    if len(codes) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    letters = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    letters ^= letters >> np.uint64(29)
    inner = letters[:len(codes) - s + 1].copy()
    for i in range(1, s):
        inner *= np.uint64(0xD6E8FEB86659FD93)
        inner += letters[i:len(codes) - s + 1 + i]
    inner = mix(inner)
    width = k - s + 1
    least, reach = inner, 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    chosen = np.flatnonzero((inner[:len(least)] == least) | (inner[width - 1:] == least))
    value = np.zeros(len(chosen), np.uint64)
    for i in [*range(0, width, s), width - 1]:
        value = mix(value + inner[chosen + i])
    return value >> np.uint64(32), chosen + low


def fingerprint(text: str) -> list[tuple[int, int]]:
    """All anchors of a text, as (hash, place), in order of place."""
    hashes, places = anchors(text)
    return list(zip(hashes.tolist(), places.tolist(), strict=True))


def written(kept: list[tuple[int, int]]) -> str:
    return " ".join(f"{value:08x}:{place}" for value, place in kept)


def likeness(one: list[tuple[int, int]], other: list[tuple[int, int]]) -> float:
    """Share of the two texts' anchors, from 0 to 1, that are common and in the same order."""
    if not one or not other:
        return float(one == other)
    return 2 * common_in_order([v for v, _ in one], [v for v, _ in other]) / (len(one) + len(other))


def common_in_order(one: list[int], other: list[int]) -> int:
    """Length of the longest common subsequence.

    Common beginnings and ends belong to it. Between them only values of both lists matter. Where
    few places pair up, pairs are followed by rising place; where values repeat, all places of a
    list are followed at once as the bits of a number. Both ways are exact.
    """
    shorter = min(len(one), len(other))
    begun = next((i for i in range(shorter) if one[i] != other[i]), shorter)
    ended = next((i for i in range(shorter - begun) if one[-1 - i] != other[-1 - i]), shorter - begun)
    one, other = one[begun:len(one) - ended], other[begun:len(other) - ended]
    both = set(one).intersection(other)
    one, other = [v for v in one if v in both], [v for v in other if v in both]
    places: dict[int, list[int]] = {}
    for place, value in enumerate(other):
        places.setdefault(value, []).append(place)
    if sum(len(places[value]) for value in one) <= len(one) * (4 + len(other) // 4096):
        rising: list[int] = []
        for value in one:
            for place in reversed(places[value]):
                at = bisect.bisect_left(rising, place)
                rising[at:at + 1] = [place]
        return begun + ended + len(rising)

    @functools.lru_cache(64)
    def standing(value: int) -> int:
        bits = bytearray(len(other) // 8 + 1)
        for place in places[value]:
            bits[place >> 3] |= 1 << (place & 7)
        return int.from_bytes(bits, "little")

    every = (1 << len(other)) - 1
    open_places = every
    for value in one:
        met = open_places & standing(value)
        open_places = ((open_places + met) | (open_places - met)) & every
    return begun + ended + len(other) - open_places.bit_count()


def _place(doc_id: Column) -> Column:
    """Rises as doc_id falls; null comes last."""
    return F.coalesce(F.bitwise_not(doc_id.cast("long")), F.lit((1 << 63) - 1))


_ORDER = np.dtype([("place", np.int64), ("tie", np.int64)])


def _order_keys(place, tie) -> np.ndarray:
    keys = np.empty(len(place), _ORDER)
    keys["place"], keys["tie"] = place, tie
    return keys


def with_next(docs: DataFrame) -> DataFrame:
    """Rows by falling doc_id in blocks: columns doc_id, text, block, place, tie, ghost.

    After the rows of a block, one row with ``ghost`` repeats the first row of the next block,
    or of the first block after the last; so each row's next document stands behind
    it in its block. One shuffle of the texts. The borders of the blocks come from a
    bounded sample of ids and do not bear on the result.
    """
    docs = in_small_batches(docs)
    text = text_of(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text,
                       _place(docs["doc_id"]).alias("place"), F.xxhash64(text).alias("tie"))
    ids = workspace.materialise(rows.select("place", "tie"), "order")
    count = ids.count()
    blocks = min(_MOST_BLOCKS, -(-count // _BLOCK_ROWS))
    if not blocks:
        return rows.withColumns({"block": F.lit(0), "ghost": F.lit(False)})
    sample = ids.filter(sampled(F.xxhash64("place", "tie", F.lit(11)), hash_bound(_SAMPLED * blocks, count))).toArrow()
    ordered = np.sort(_order_keys(sample["place"].to_numpy(), sample["tie"].to_numpy()))
    borders = ordered[(np.arange(1, blocks) * len(ordered)) // blocks] if len(ordered) else ordered

    @F.pandas_udf(T.IntegerType())
    def block_of(place: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, _order_keys(place, tie), "right").astype(np.int32))

    block = block_of("place", "tie")
    first = (ids.withColumn("block", block).groupBy("block").agg(F.min(F.struct("place", "tie")).alias("first"))
             .orderBy("block").select("block", "first.*").collect())
    into = [(row["place"], row["tie"], first[i - 1]["block"]) for i, row in enumerate(first)]
    heads = docs.sparkSession.createDataFrame(into, "place long, tie long, block int")
    ghosts = rows.join(F.broadcast(heads), ["place", "tie"]).dropDuplicates(["place", "tie"])
    every = (rows.withColumn("block", block).withColumn("ghost", F.lit(False))
             .unionByName(ghosts.withColumn("ghost", F.lit(True))))
    return every.repartition("block").sortWithinPartitions("block", "ghost", "place", "tie")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    doc_id = text = kept = block = None
    for batch in batches:
        out = []
        rows = zip(batch["doc_id"].to_pylist(), batch["block"].to_pylist(), batch["text"], strict=True)
        for next_id, next_block, value in rows:
            next_text = value.as_py()
            next_kept = fingerprint(next_text)
            if next_block == block:
                half = len(text) // 2
                edited = text[:len(text) - half] + next_text[:half]
                changed = fingerprint(edited)
                out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(kept),
                            written(changed), likeness(kept, changed), likeness(kept, next_kept)))
            doc_id, text, kept, block = next_id, next_text, next_kept, next_block
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RESULT, strict=True)], schema=_RESULT)


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of an edited text, and the likeness of its own to that
    and to the next document's. In the edited text the last half of the characters (rounded down) is
    replaced by as many of the beginning of the next document, by falling doc_id."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return with_next(docs).select("doc_id", "block", "text").mapInArrow(_compare, schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and its anchors as an array of (hash, place)."""
    @F.pandas_udf("array<struct<hash: long, place: long>>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [{"hash": v, "place": p} for v, p in fingerprint(text)])

    return docs.select(docs["doc_id"].alias("doc_id"), of(text_of(docs)).alias("anchors"))

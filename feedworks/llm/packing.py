"""Packing token pieces into windows by Karmarkar-Karp multiway differencing.

Documents become token ids with an end mark, cut into near-equal pieces. Pieces
are dealt at random into groups of about :data:`GROUP_WINDOWS` windows; a long
document spreads over many groups. Within a group, every piece starts as a
partition of its own: itself in one of k windows, nothing in the others. The two
partitions with the largest imbalance are merged, the fullest windows of one with
the emptiest of the other, until one is left. k is the least that could do; it
rises by one whenever a window comes out over capacity.

Defined results: null text is empty; an empty text is its end mark alone; equal
rows are packed each; no rows give no rows.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedworks.llm.rows import AT, FILE, in_small_batches, numbered, text_of

CAPACITY = 2048
#: Written after each document.
END_ID = 1
#: Most tokens of a piece. A number that does not divide the capacity mixes well (under 1 % padding).
PIECE_TOKENS = 470
#: Windows and pieces aimed at in a group; what a task holds at once.
GROUP_WINDOWS, GROUP_PIECES = 128, 4096
#: Tokens after which a task hands on what it has encoded.
_BATCH_TOKENS = 1 << 20

#: Fixed values of the byte-level vocabulary: how it cuts text before merging, and its one special token.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPECIAL = {"<|endoftext|>": 50256}

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary())])


@functools.cache
def _encoder(path: str):
    """Encoder for a vocabulary file of ranks, loaded once per worker."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=_SPECIAL)


def encode(text: str, vocabulary: str) -> np.ndarray:
    """The ids of a text and its end mark."""
    ids = _encoder(vocabulary).encode_to_numpy(text, allowed_special="all")
    return np.append(ids, END_ID).astype("<u4")


def vocabulary_path() -> str:
    """Ranks of the vocabulary that ``byte_bpe_50k.json`` describes. Both files give
    the same ids; this one is encoded four times as fast."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_pieces(docs: DataFrame, vocabulary: str | None = None, piece_tokens: int = PIECE_TOKENS) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, and ``ids`` as
    little-endian unsigned 32-bit numbers.

    ``vocabulary`` is the path of the ranks on every machine; by default the
    installed public one, found where the task runs.
    """

    docs = in_small_batches(docs)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or vocabulary_path()
        rows, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = encode(text.as_py(), path)
                cuts = piece_borders(len(ids), piece_tokens)
                rows += [(doc_id, low, high - low, len(ids), ids[low:high].tobytes())
                         for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
                tokens += len(ids)
                if tokens >= _BATCH_TOKENS:
                    yield _batch(rows)
                    rows, tokens = [], 0
        if rows:
            yield _batch(rows)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs)).mapInArrow(
        pieces, "doc_id long, start long, length long, doc_tokens long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)


def piece_borders(tokens: int, most: int) -> list[int]:
    """Cuts into the fewest pieces of at most so many tokens, equal to one token."""
    n = -(-tokens // most)
    return [tokens * i // n for i in range(n + 1)]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, the place in that sequence.

    ``pieces`` is a written table with a column ``length`` of 1 to ``capacity``;
    its other columns go along. One shuffle, by group.
    """
    tokens, count = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-tokens // (capacity * GROUP_WINDOWS)), -(-count // GROUP_PIECES))

    def pack_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([FILE, AT], ignore_index=True)
        lengths = group["length"].to_numpy()
        window = near_equal_windows(lengths, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(lengths[order])
        opens = np.r_[True, np.diff(window[order]) > 0]
        starts = ends - lengths[order]
        offset = np.empty(len(group), np.int64)
        offset[order] = starts - np.maximum.accumulate(np.where(opens, starts, 0))
        group["sequence_id"] = group["__group"] * (1 << 20) + window
        group["offset"] = offset
        return group.drop(columns=["__group", FILE, AT])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    rows = numbered(pieces, *[pieces[c] for c in pieces.columns])
    return (rows.withColumn("__group", F.pmod(F.xxhash64(FILE, AT), F.lit(groups)))
            .groupBy("__group").applyInPandas(pack_group, schema))


def near_equal_windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece, none over capacity."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window, fullest = differencing(lengths, k)
        if fullest <= capacity:
            return window
        k += 1


def differencing(lengths: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Splits pieces over k windows; returns the window of each and the fullest's size.

    A partition holds its windows from fullest to emptiest: their sizes, and the
    first and last piece of each. ``after`` chains the pieces of a window.
    """
    window = np.zeros(len(lengths), np.int64)
    if k == 1:
        return window, int(lengths.sum())
    after = np.full(len(lengths), -1)

    def alone(piece: int):
        sizes = np.zeros(k, np.int64)
        ends = np.full(k, -1)
        sizes[0], ends[0] = lengths[piece], piece
        return sizes, ends, ends.copy()

    queue = [(-int(length), piece, None) for piece, length in enumerate(lengths)]
    heapq.heapify(queue)
    number = len(lengths)
    while len(queue) > 1:
        _, piece, one = heapq.heappop(queue)
        sizes, heads, tails = one or alone(piece)
        _, piece, other = heapq.heappop(queue)
        if other is None:
            # One piece goes to the emptiest window.
            sizes[-1] += lengths[piece]
            if tails[-1] >= 0:
                after[tails[-1]] = piece
            else:
                heads[-1] = piece
            tails[-1] = piece
        else:
            opposed, its_heads, its_tails = (part[::-1] for part in other)
            sizes = sizes + opposed
            both = (tails >= 0) & (its_heads >= 0)
            after[tails[both]] = its_heads[both]
            heads, tails = np.where(heads >= 0, heads, its_heads), np.where(its_tails >= 0, its_tails, tails)
        order = np.argsort(-sizes, kind="stable")
        sizes, heads, tails = sizes[order], heads[order], tails[order]
        heapq.heappush(queue, (int(sizes[-1] - sizes[0]), number, (sizes, heads, tails)))
        number += 1

    _, piece, last = queue[0]
    sizes, heads, _ = last or alone(piece)
    for number, piece in enumerate(heads):
        while piece >= 0:
            window[piece] = number
            piece = after[piece]
    return window, int(sizes[0])

"""Hashes of the words in a batch of texts, computed on whole arrays.

Works on the UTF-8 bytes of an Arrow string column, some megabytes at a time, so
that a task holds little besides the batch it was given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: By byte: white space; and all of ASCII that isn't a letter or digit.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The powers 0 to n of the base, or of its inverse."""
    if len(_powers[kind]) <= n:
        steps = np.full(max(n + 1, CHUNK_BYTES + 1), _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields first row, row after the last, bytes, and offsets of the rows in them."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


class Words:
    """The words of a chunk: ``start`` and ``end`` in its bytes, ``first[i]`` to
    ``first[i + 1]`` the words of row i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE):
        data = _LOWER[data]
        solid = ~between[data]
        before = np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = solid[1:]
        borders = offsets[:-1][offsets[:-1] < len(data)]
        before[borders] = False
        borders = offsets[1:][offsets[1:] > 0] - 1
        after[borders] = False
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power("up", len(data))[:len(data)], out=self._sums[1:])

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """One 64-bit number per word, or per byte range given."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        span = self._sums[end] - self._sums[start]
        return mix(span * _power("down", int(start.max(initial=0)))[start] + (end - start).astype(np.uint64))

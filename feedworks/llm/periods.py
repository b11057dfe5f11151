"""Periodic runs of words, found with a grammar made by recompression.

A run is a stretch of words that repeats with its smallest period and can't be made longer;
see :func:`periodic_runs` for the lengths that count. The words of some documents stand one
after another in a chunk, each document ended by a symbol of its own.

* Recompression turns the chunk into a grammar: in alternation, each block of one symbol
  becomes a symbol (for symbol and length), then neighbours of which the first is in one half of
  the symbols and the second in the other become one (for both). Equal stretches are
  replaced in the same way but for their ends.
* How far two places agree, forwards or backwards, is read from the grammar: up through
  the levels while whole symbols agree, down again from the first that differ. At every
  level that is one comparison, of whole blocks too.
* A run of period p agrees with itself p words on over at least max(24 - p, 2p) places, so
  one of them is on a grid of that width. All places of all grids, a harmonic sum, are
  tried in whole arrays; where the word p places on is the same, the grammar gives the exact
  extension. A stretch found with several periods has the least of them.

Defined results: null or empty text has no words and no runs; a document is worked on as a
whole by one task, in memory of some hundred bytes a word, whatever its length; rows don't
depend on each other, so equal rows and ties have equal results; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks import workspace
from feedworks.llm.rows import WORD, small_batches, text_of

#: Least length of a run, in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of a chunk; a longer document is a chunk of its own.
CHUNK_WORDS = 1 << 16
#: Grid places tried at once.
_AT_ONCE = 1 << 19
#: Periods up to which a grid is tried on its own, so long are its arrays.
_SINGLE = 48
#: Multiplier whose upper bits deal symbols to the halves.
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Level:
    """A row of the grammar: its symbols, and where the symbols of the next one begin in it."""

    def __init__(self, symbols: np.ndarray, begins: np.ndarray, blocks: bool):
        self.symbols, self.begins, self.blocks = symbols, begins, blocks
        self.first = np.r_[np.flatnonzero(begins), len(symbols)]
        self.above = np.cumsum(begins) - 1


class Grammar:
    """Levels of recompression over ``symbols``, numbers below their count. The last level
    is short and compared symbol by symbol."""

    def __init__(self, symbols: np.ndarray, most_left: int):
        self.levels: list[Level] = []
        names = int(symbols.max(initial=0)) + 1
        turn = 0
        while len(symbols) > most_left:
            begins = np.r_[True, symbols[1:] != symbols[:-1]]
            if not begins.all():
                level = Level(symbols, begins, True)
                length = np.diff(level.first)
                symbols = symbols[level.first[:-1]]
                long = np.flatnonzero(length > 1)
                symbols[long], names = _named(symbols[long], length[long], names)
                self.levels.append(level)
            turn += 1
            half = ((symbols.astype(np.uint64) + np.uint64(turn)) * _ODD * np.uint64(2 * turn + 1)) >> np.uint64(63)
            pairs = np.flatnonzero((half[:-1] == 0) & (half[1:] == 1))
            if not len(pairs):
                continue
            begins = np.ones(len(symbols), bool)
            begins[pairs + 1] = False
            level = Level(symbols, begins, False)
            joined, names = _named(symbols[pairs], symbols[pairs + 1], names)
            symbols = symbols.copy()
            symbols[pairs] = joined
            symbols = symbols[begins]
            self.levels.append(level)
        self.top = symbols

    def forwards(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For how many symbols the places agree, their own included."""
        return self._agree(one, two, 1) - one

    def backwards(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For how many symbols the places agree before their own."""
        return one - self._agree(one, two, -1)

    def _agree(self, one: np.ndarray, two: np.ndarray, way: int) -> np.ndarray:
        """Where the first place ends up. Places are borders between symbols."""
        behind = 0 if way > 0 else -1
        a, b = one.copy(), two.copy()
        rows = np.arange(len(a))
        stopped = []
        for level in self.levels:
            at_border = level.begins
            # Going backwards, a border is one where a symbol of the next level has ended.
            inner = ~(at_border[a] & at_border[b])
            if inner.any():
                places = np.flatnonzero(inner)
                x, y = a[places], b[places]
                same = level.symbols[x + behind] == level.symbols[y + behind]
                if level.blocks:
                    left, right = self._rest(level, x, way), self._rest(level, y, way)
                    step = np.where(same, np.minimum(left, right), 0)
                    on = same & (left == right)
                else:
                    step, on = same.astype(np.int64), same
                a[places], b[places] = x + way * step, y + way * step
                end = places[~on]
                stopped.append((rows[end], a[end], b[end]))
                keep = np.ones(len(a), bool)
                keep[end] = False
                rows, a, b = rows[keep], a[keep], b[keep]
            else:
                stopped.append((rows[:0], a[:0], b[:0]))
            a, b = level.above[a], level.above[b]
        open_ = np.arange(len(rows))
        while len(open_):
            open_ = open_[self.top[a[open_] + behind] == self.top[b[open_] + behind]]
            a[open_] += way
            b[open_] += way
        for level, (more, x, y) in zip(reversed(self.levels), reversed(stopped), strict=True):
            a, b = level.first[a], level.first[b]
            same = level.symbols[a + behind] == level.symbols[b + behind]
            if level.blocks:
                step = np.where(same, np.minimum(self._rest(level, a, way), self._rest(level, b, way)), 0)
            else:
                step = same.astype(np.int64)
            a, b = np.r_[a + way * step, x], np.r_[b + way * step, y]
            rows = np.r_[rows, more]
        out = np.empty(len(one), np.int64)
        out[rows] = a
        return out

    @staticmethod
    def _rest(level: Level, at: np.ndarray, way: int) -> np.ndarray:
        """Symbols from a place to the end of its block, or back to its begin."""
        if way > 0:
            return level.first[level.above[at] + 1] - at
        return at - level.first[level.above[at - 1]]


def _named(one: np.ndarray, two: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    """A new number for each pair that occurs, the same for the same pair."""
    both = (one.astype(np.int64) << np.int64(32)) | two.astype(np.int64)
    kinds, number = np.unique(both, return_inverse=True)
    return number + names, names + len(kinds)


def _grids(n: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to try, in arrays of bounded size."""
    width = lambda p: np.maximum(LEAST_WORDS - p, (LEAST_PERIODS - 1) * p)
    for p in range(1, min(_SINGLE, most) + 1):
        for start in range(0, n - p, int(width(p)) * _AT_ONCE):
            at = np.arange(start, min(n - p, start + int(width(p)) * _AT_ONCE), int(width(p)))
            yield at, np.full(len(at), p)
    p = _SINGLE + 1
    while p <= most:
        # At least one period, and as many as fill the array.
        last = min(most, p + max(0, _AT_ONCE * int(width(p)) // n))
        periods = np.arange(p, last + 1)
        counts = -(-(n - periods) // width(periods))
        period = np.repeat(periods, counts)
        number = np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield number * width(period), period
        p = last + 1


def runs(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All runs of a chunk as rows of begin, end and period, by begin, then period.

    ``symbols`` begins with a symbol that occurs nowhere else, as do the places ``ends``, in
    rising order, one behind each document."""
    longest = int(np.diff(np.r_[0, ends]).max(initial=1)) - 1
    found = [np.zeros((0, 3), np.int64)]
    grammar = None
    document = np.repeat(np.arange(len(ends)), np.diff(np.r_[-1, ends]))
    for at, period in _grids(len(symbols), longest // LEAST_PERIODS):
        alike = np.flatnonzero(symbols[at] == symbols[at + period])
        at, period = at[alike], period[alike]
        inside = document[at] == document[at + period]
        at, period = at[inside], period[inside]
        if not len(at):
            continue
        if grammar is None:
            grammar = Grammar(symbols, 2 * len(ends) + 32)
        begin = at - grammar.backwards(at, at + period)
        end = at + period + grammar.forwards(at, at + period)
        long = end - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.unique(np.stack([begin[long], end[long], period[long]], axis=1), axis=0))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    # Of a stretch found with several periods the first row has the least.
    least = np.r_[True, (every[1:, :2] != every[:-1, :2]).any(axis=1)][:len(every)]
    every = every[least]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


class _Numbers(dict):
    """A number for each word, in the order in which they are asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of the texts, some documents at a time."""
    held, count = [], 0
    for text in texts:
        words = text.as_py().split()
        held.append(words)
        count += len(words)
        if count >= CHUNK_WORDS:
            yield held
            held, count = [], 0
    if held:
        yield held


def _of_chunk(documents: list[list[bytes]]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Per document its runs, from its own first word on, and its text without repetitions."""
    lengths = np.array([len(words) for words in documents])
    ends = np.cumsum(lengths + 1)
    symbols = np.empty(int(ends[-1]) + 1, np.int64)
    numbers = _Numbers()
    for end, words in zip(ends.tolist(), documents):
        symbols[end - len(words):end] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    symbols[0], symbols[ends] = len(numbers), len(numbers) + 1 + np.arange(len(ends))
    found = runs(symbols, ends)
    of = np.searchsorted(found[:, 0], np.r_[0, ends])
    for number, (low, high) in enumerate(pairwise(of.tolist())):
        words = documents[number]
        own = found[low:high] - np.array([1, 1, 0]) * (ends[number] - len(words))
        if len(own):
            covered = np.zeros(len(words) + 1, np.int64)
            np.add.at(covered, own[:, 0] + own[:, 2], 1)
            np.add.at(covered, own[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(covered[:-1]) == 0).tolist()]
        yield own, b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for documents in _chunks(batch["text"].cast(pa.large_binary())):
            found = list(_of_chunk(documents))
            every = np.concatenate([own for own, _ in found])
            offsets = np.r_[0, np.cumsum([len(own) for own, _ in found])].astype(np.int32)
            fields = [every[:, 0], every[:, 1] - every[:, 0], every[:, 2]]
            rows = batch.slice(at, len(documents))
            at += len(documents)
            yield pa.RecordBatch.from_arrays([
                rows["row"], pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(_RUN))),
                pa.array([text for _, text in found], pa.binary()).cast(pa.string())], names=["row", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: Column | None = None, *keep: str) -> DataFrame:
    """Per document the columns ``keep``, ``runs`` (array of start, length, period in words,
    by start, then period) and ``collapsed``, its words without those that a run repeats,
    joined by a space; written.

    Runs have at least :data:`LEAST_WORDS` words and :data:`LEAST_PERIODS` periods. ``text``
    is the text column unless another is given."""
    text = text_of(docs) if text is None else F.coalesce(text.cast("string"), F.lit("")).alias("text")
    kept = F.struct(*[docs[f"`{c}`"].alias(c) for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(kept.alias("row"), text)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    with small_batches(docs.sparkSession):
        return workspace.materialise(
            rows.mapInArrow(_runs, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "runs", "collapsed"), "periodic_runs")


def with_repeats(text: Column, doc_id: Column) -> Column:
    """The text with a repetition put into about one document in ten, by checksum of its id:
    with h the checksum and g = h div 10, if 10 divides h, the words from number
    a = g mod n on repeat the first 1 + (n - a) div (3 + g mod 8) of them. Rows without
    an id keep their text."""
    check = F.crc32(doc_id.cast("string"))
    g = F.floor(check / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    period = (F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))) + 1).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, period), times))
    altered = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return F.when((check % 10 == 0) & (n > 0), altered).otherwise(text)

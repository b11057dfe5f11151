"""Periodic runs against brute force."""

import hashlib
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from frames import awkward, clashing, documents, plain
from oracle import spark_rows

from feedworks.llm import periods
from feedworks.llm.queries import op11_periodic_runs

SF_DIR = os.environ.get("FEEDWORKS_SF_DIR", "/root/testdata/sf0.001")


def runs_by_hand(words):
    """Maximal stretches of each period, those with the smallest one for the stretch."""
    n, found = len(words), {}
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    array = np.array([numbers[w] for w in words], np.int64)
    for p in range(1, n // 3 + 1):
        same = np.r_[False, array[:-p] == array[p:], False]
        borders = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(borders[::2].tolist(), borders[1::2].tolist()):
            if end + p - begin >= max(24, 3 * p):
                found.setdefault((begin, end + p), p)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda run: (run[0], run[2]))


def collapsed_by_hand(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def repeating(seed, letters="ab"):
    """A text in which stretches are repeated, within repeated stretches too."""
    rng = random.Random(seed)
    words = []
    while len(words) < rng.choice([10, 60, 300]):
        part = rng.choices(letters, k=rng.randint(1, 30))
        part = part * rng.randint(1, 9) + part[:rng.randrange(len(part))]
        words += part + (words[-rng.randint(1, 80):] * rng.randint(0, 4) if rng.random() < 0.4 else [])
    return words


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_runs_of_a_chunk(letters, monkeypatch):
    monkeypatch.setattr(periods, "_AT_ONCE", 64)
    documents = [repeating(seed, letters) for seed in range(40)] + [[], ["a"] * 23, ["a"] * 24, ["a"], list("ab") * 2000]
    for (own, text), words in zip(periods._of_chunk([[w.encode() for w in d] for d in documents]), documents, strict=True):
        expected = runs_by_hand(words)
        assert [(s, e - s, p) for s, e, p in own.tolist()] == expected
        assert text.decode() == collapsed_by_hand(words, expected)


@pytest.mark.parametrize("letters", [1, 2, 4, 50])
def test_extensions(letters):
    rng = np.random.default_rng(letters)
    n = 3000
    symbols = rng.integers(0, letters, n)
    symbols[1500:2300] = symbols[200:1000]
    symbols[2310:2900] = np.resize(symbols[2310:2317], 590)
    symbols[[0, -1]] = [letters, letters + 1]
    grammar = periods.Grammar(symbols, 20)
    one = np.r_[rng.integers(1, n - 1, 3000), rng.integers(200, 1000, 300), np.arange(2310, 2800)]
    two = np.r_[rng.integers(1, n - 1, 3000), one[3000:3300] + 1300, np.arange(2317, 2807)]
    one, two = np.minimum(one, two)[one != two], np.maximum(one, two)[one != two]

    def agree(i, j, way):
        count = 0
        while symbols[i + way * count - (way < 0)] == symbols[j + way * count - (way < 0)]:
            count += 1
        return count

    assert grammar.forwards(one, two).tolist() == [agree(i, j, 1) for i, j in zip(one.tolist(), two.tolist())]
    assert grammar.backwards(one, two).tolist() == [agree(i, j, -1) for i, j in zip(one.tolist(), two.tolist())]


def test_grammar_is_logarithmic():
    """Neither a long block nor a long period makes more levels than words do."""
    for symbols in (np.zeros(1 << 16, np.int64), np.tile(np.arange(100), 700), np.arange(1 << 16)):
        grammar = periods.Grammar(np.r_[1 << 17, symbols, (1 << 17) + 1], 32)
        assert len(grammar.levels) < 150


def rows_with_runs():
    rows = [(i, " ".join(repeating(i, "abc")), "s") for i in range(60)] + awkward(60)
    return rows + [(900 + i, " ".join(f"w{j % (i * 7 + 1)}" for j in range(500)), "s") for i in range(40)]


def test_operator(spark, tmp_path):
    rows = rows_with_runs()
    docs = clashing(documents(spark, rows, tmp_path / "docs"))
    found = periods.periodic_runs(docs, None, "doc_id", "row")
    expected = []
    for row in rows:
        runs = runs_by_hand(words_of(row[1]))
        expected.append((row[0], [tuple(r) for r in runs], collapsed_by_hand(words_of(row[1]), runs), "theirs"))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"], r["row"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def result_by_hand(doc_id, text):
    words = altered(doc_id, words_of(text))
    runs = runs_by_hand(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {"doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None, "runs_sha256": digest(lines),
            "collapsed_sha256": digest(collapsed_by_hand(words, runs))}


def compared(spark, sf_dir):
    columns, rows = spark_rows(op11_periodic_runs(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = [result_by_hand(*row) for row in docs]
    assert rows == sorted([tuple(row[c] for c in columns) for row in expected], key=repr)
    return expected


def test_query_on_planted_rows(spark, tmp_path):
    documents(spark, rows_with_runs(), tmp_path / "documents.parquet")
    expected = compared(spark, str(tmp_path))
    assert sum(row["n_runs"] > 1 for row in expected) > 20


def test_query_on_the_given_table(spark):
    expected = compared(spark, SF_DIR)
    assert any(row["n_runs"] for row in expected) and not all(row["n_runs"] for row in expected)


def test_empty(spark):
    assert plain(periods.periodic_runs(documents(spark, []), None, "doc_id"), "doc_id", "runs") == []

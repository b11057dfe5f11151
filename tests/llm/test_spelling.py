"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from frames import awkward, clashing, documents, plain

from feedworks.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def words_by_hand(rows):
    counts = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(one, two):
    """Exactly one code point inserted, deleted or replaced."""
    if len(one) > len(two):
        one, two = two, one
    if one == two or len(two) - len(one) > 1:
        return False
    i = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), len(one))
    return one[i + (len(one) == len(two)):] == two[i + 1:]


def groups_by_hand(rows):
    words = words_by_hand(rows)
    beside = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(beside[w]), words.get(form[w])))
    return sorted(out, key=repr)


def variants(n, seed, letters="abcdeé"):
    """Texts of words and of words a letter or two apart from them, some far more often."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(n)]
    every = list(base)
    for word in base:
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind != 1):]
            every.append(word)
    texts = []
    for i in range(60):
        some = rng.choices(every, k=200)
        texts.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in some) + "," + every[0]))
    return texts


@pytest.mark.parametrize("letters", ["abcdeé", "ab", "abcdefghijklmnopqrstuvwxyz"])
def test_groups(spark, tmp_path, letters):
    rows = variants(120, len(letters), letters) + awkward(30)
    docs = documents(spark, rows, tmp_path / "docs")
    expected = groups_by_hand(rows)
    assert sum(row[1] is not None for row in expected) > 10
    assert plain(spelling.variant_groups(clashing(docs)), *COLUMNS) == expected


@pytest.mark.parametrize("bucket, levels", [(1, 2), (3, 4)])
def test_deep_tries(spark, monkeypatch, bucket, levels):
    """Few words to a leaf, and prefixes shared by many words down to their ends."""
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    monkeypatch.setattr(spelling, "LEVELS", levels)
    rng = random.Random(bucket)
    words = {"a" * n for n in range(5, 16)} | {"abcabc" * 2 + "".join(rng.choices("ab", k=4)) for _ in range(16)}
    words |= {"".join(rng.choices("ab", k=rng.randint(5, 8))) for _ in range(150)}
    frame = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    expected = sorted(((a, b) for a in words for b in words if near(a, b)), key=repr)
    assert plain(spelling.neighbours(frame), "word", "near") == expected


def test_long_words_cost_no_more_rounds(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(spelling, "_step", lambda *a, step=spelling._step: calls.append(1) or step(*a))
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh", k=20_000))
    words = [long, long[:7000] + "x" + long[7000:], long[:15_000] + long[15_001:], long[:-1] + "z", "other", "others", "odder"]
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    expected = sorted(((a, b) for a in words for b in words if near(a, b)), key=repr)
    assert plain(spelling.neighbours(frame), "word", "near") == expected
    assert len(calls) <= 2


def test_empty(spark):
    assert spelling.variant_groups(documents(spark, [])).collect() == []
    assert spelling.variant_groups(documents(spark, [(1, None), (2, "one two"), (3, "")])).collect() == []

"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from frames import awkward, clashing, documents, plain
from pyspark.sql import functions as F

from feedworks.llm import exact, neardup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = True
        for i in sorted(ids, key=lambda i: i != keep):
            out.append((i, keep, len(ids), i == keep and stays, hashlib.sha256(text.encode()).hexdigest()))
            stays = False
    return sorted(out, key=repr)


EXACT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("written", [True, False])
def test_exact_groups(spark, tmp_path, written):
    rows = awkward()
    docs = documents(spark, rows, tmp_path / "docs" if written else None)
    assert plain(exact.exact_groups(clashing(docs)), *EXACT) == exact_by_hand(rows)


def test_exact_chains_of_one_key(spark, tmp_path):
    rows = awkward(60, 1) + [(500, "É"), (501, "é"), (502, "e"), (503, "E")]
    found = exact.exact_groups(documents(spark, rows, tmp_path / "docs"), key=lambda text: F.length(text).cast("long") % 3)
    assert plain(found, *EXACT) == exact_by_hand(rows)


def test_exact_of_many_keys_compares_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact, "broadcast_if_small", lambda df, rows=0: df)
    rows = awkward(50, 2)
    assert plain(exact.exact_groups(documents(spark, rows, tmp_path / "docs")), *EXACT) == exact_by_hand(rows)


@pytest.mark.parametrize("least", [16, 3])
def test_directory_splits_overfull_buckets_only(spark, monkeypatch, least):
    monkeypatch.setattr(exact, "LEAST_BITS", least)
    bits = exact.directory_bits(4000, 100)
    assert bits == max(least, 10)
    # Half of the keys share their first bits, so their buckets need more doublings.
    keys = spark.createDataFrame([((i << 40) if i % 2 else (i * 0x9E3779B97F4A7C15) % (1 << 63),) for i in range(4000)], "key long")
    rows = exact.directory(keys, bits, 100).collect()
    held = Counter()
    bucket = {row["prefix"]: row for row in rows}
    for (key,) in keys.collect():
        held[bucket[key >> (64 - bits)]["bucket"]] += 1
    for row in rows:
        assert held[row["bucket"]] <= 100 or row["depth"] == bits
        assert row["bucket"] == row["prefix"] >> (bits - row["depth"]) << (bits - row["depth"])
    assert len({row["depth"] for row in rows}) > 1


def test_depth_follows_the_number_of_keys():
    assert exact.directory_bits(0) == exact.directory_bits(1 << 24) == 16
    assert [exact.directory_bits(1 << n) for n in (25, 30, 37, 80)] == [17, 22, 29, 63]


def test_exact_in_a_deep_directory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact, "LEAST_BITS", 1)
    rows = awkward(120, 3)
    found = exact.exact_groups(documents(spark, rows, tmp_path / "docs"), bucket_keys=2)
    assert plain(found, *EXACT) == exact_by_hand(rows)


def test_exact_empty(spark):
    assert exact.exact_groups(documents(spark, [])).collect() == []


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def near_by_hand(rows):
    sets = [shingles(row[1]) for row in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((row[0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr), len(set(label))


NEAR = ["doc_id", "n_shingles", "component_id"]


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return words


def near_rows(seed):
    """Chains of edits, stars of edits, copies, short texts, and shared passages."""
    rng = random.Random(seed)
    new = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    texts = []
    passage = new(50)
    for _ in range(6):
        words = new(rng.randint(60, 200))
        for _ in range(8):
            texts.append(words)
            words = edited(rng, words, rng.randint(1, 4))
    for _ in range(4):
        words = new(rng.randint(40, 120))
        texts += [edited(rng, words, rng.randint(0, 3)) for _ in range(12)]
    texts += [new(60) + passage for _ in range(25)] + [new(3), new(4), new(5), [], ["A", "b"], ["a", "B"]] * 2
    rng.shuffle(texts)
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, tmp_path, seed):
    rows = near_rows(seed)
    expected, components = near_by_hand(rows)
    found = neardup.near_duplicates(clashing(documents(spark, rows, tmp_path / "docs"))).cache()
    assert plain(found, *NEAR) == expected
    assert found.filter("stays").count() == components


def test_near_duplicates_in_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = near_rows(3)
    assert plain(neardup.near_duplicates(documents(spark, rows, tmp_path / "docs")), *NEAR) == near_by_hand(rows)[0]


def test_near_duplicates_of_awkward_rows(spark):
    rows = awkward(20, 4)
    expected, components = near_by_hand(rows)
    found = neardup.near_duplicates(documents(spark, rows)).cache()
    assert plain(found, *NEAR) == expected
    # Rows without words stand alone.
    assert found.filter("stays").count() == components


def test_near_duplicates_empty(spark):
    assert neardup.near_duplicates(documents(spark, [])).collect() == []
    assert neardup.near_duplicates(documents(spark, [(1, ""), (2, None)])).count() == 2


def test_components_of_long_chains(spark):
    rng = random.Random(5)
    names = rng.sample(range(10 ** 6), 300)
    links = spark.createDataFrame(list(zip(names, names[1:])) + [(-5, -3), (-3, -4)], "a long, b long")
    found = {row["id"]: row["component"] for row in neardup.components(links).collect()}
    assert found == {**dict.fromkeys(names, min(names)), -3: -5, -4: -5, -5: -5}

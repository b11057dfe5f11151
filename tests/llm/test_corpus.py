"""Mixing, packing and the pipeline, against brute force and round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from frames import awkward, clashing, documents, plain
from pyspark.sql import functions as F

import corpus_pipeline
from feedworks import workspace
from feedworks.llm import mixing, packing
from feedworks.llm.queries import packed_pieces


def size(text):
    import re

    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("block_words", [1, 8, 128])
def test_mix(spark, tmp_path, block_words):
    rows = awkward(120, 7)
    found = mixing.mix(clashing(documents(spark, rows, tmp_path / "docs")), block_words=block_words).collect()
    assert sorted((r["doc_id"], r["size"], r["source"]) for r in found if r["doc_id"] is not None and r["source"]) == sorted(
        (row[0], size(row[1]), row[2]) for row in rows if row[0] is not None and row[2])
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[2]] += size(row[1])
    target = targets_by_hand(sizes)
    taken = defaultdict(int)
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]])
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
    for source, words in taken.items():
        assert abs(words - target[source]) <= block_words + 1
    again = mixing.mix(documents(spark, rows), block_words=block_words)
    assert plain(again, "doc_id", "source", "size", "taken") == sorted(
        ((r["doc_id"], r["source"], r["size"], r["taken"]) for r in found), key=repr)


def test_every_target_is_taken_however_small_the_source(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, "word " * 600, "large" if i % 8 < 5 else "much") for i in range(160)]
    rows += [(1000 + i, "word " * rng.randint(5, 59), f"tiny{i:04d}") for i in range(400)]
    rows += [(3000 + i, "one", f"one{i}") for i in range(20)]
    docs = documents(spark, rows, tmp_path / "docs")
    taken, target, held = defaultdict(int), {}, defaultdict(int)
    for row in mixing.mix(docs).collect():
        taken[row["source"]] += row["taken"]
        target[row["source"]], held[row["source"]] = row["target"], row["source_size"]
    assert len(target) == 422 and sum(target[s] == 3 * held[s] for s in target) > 300
    assert dict(taken) == {s: int(words + 0.5) for s, words in target.items()}
    # No slot is given twice or beyond the schedule, and none takes more than a block.
    sizes = mixing.document_sizes(docs)
    sources = mixing.source_targets(sizes)
    slots = [row["slot"] for row in mixing.source_slots(sources).collect()]
    assert sorted(slots) == list(range(len(slots)))
    filled = defaultdict(int)
    for row in mixing.schedule(sizes, sources).collect():
        filled[row["slot"]] += row["words"]
    assert max(filled.values()) <= mixing.BLOCK_WORDS


def test_ranks_of_slots_are_those_counted(spark):
    for bits, low, high in [(0, 0, 1), (5, 3, 17), (9, 0, 512), (9, 100, 101), (10, 511, 900)]:
        points = np.arange(low, high)
        slots = mixing.reverse_bits(points, bits)
        rank = mixing.points_below(slots, high, bits) - mixing.points_below(slots, low, bits)
        assert (rank[np.argsort(slots)] == np.arange(high - low)).all()


def test_every_run_of_slots_holds_the_sources_in_proportion(spark, tmp_path):
    rows = [(i, "word " * 50, "ab"[i % 2]) for i in range(200)]
    sizes = mixing.document_sizes(documents(spark, rows, tmp_path / "docs"))
    sources = mixing.source_targets(sizes, weights=(3, 1), block_words=16)
    slots = mixing.source_slots(sources).orderBy("slot").collect()
    assert [row["slot"] for row in slots] == list(range(len(slots)))
    first = np.cumsum([row["number"] == 0 for row in slots])
    share = 0.75
    assert np.abs(first - share * np.arange(1, len(slots) + 1)).max() <= np.log2(len(slots))


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None), (2, "")])).collect()] == [0, 0]


def windows_hold(pieces, capacity):
    by_window = defaultdict(list)
    for p in pieces:
        by_window[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in by_window.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_window)


def test_packing_round_trip(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = awkward(60, 8) + [(900, "a<|endoftext|>b  \n\n c's é\U0001f600 1234567")]
    docs = clashing(documents(spark, rows, tmp_path / "docs"))
    pieces = packing.pack(workspace.materialise(packing.token_pieces(docs), "pieces")).collect()
    windows_hold(pieces, packing.CAPACITY)
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(repr((row[0], reference.encode(row[1] or "", add_special_tokens=False).ids + [1])) for row in rows)
    whole = defaultdict(list)
    for p in pieces:
        if p["doc_id"] is not None and p["doc_id"] >= 50:
            whole[p["doc_id"]].append((p["start"], p["length"], p["doc_tokens"], np.frombuffer(p["ids"], "<u4").tolist()))
    for doc_id, parts in whole.items():
        ids, at = [], 0
        for start, length, tokens, part in sorted(parts):
            if start < at:
                continue  # a repeated row
            assert start == at and length == len(part)
            ids, at = ids + part, at + length
        assert at == tokens
        assert repr((doc_id, ids)) in expected
    assert sum(p["length"] for p in pieces) == sum(
        len(reference.encode(row[1] or "", add_special_tokens=False).ids) + 1 for row in rows)


def test_packed_query_has_checksums(spark, tmp_path):
    docs = documents(spark, [(1, "some words here"), (2, None)], tmp_path / "docs")
    found = {row["doc_id"]: row for row in packed_pieces(docs).collect()}
    ids = packing.encode("some words here", packing.vocabulary_path())
    assert found[1]["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
    assert (found[2]["doc_tokens"], found[2]["ids_crc32"]) == (1, zlib.crc32(np.array([1], "<u4").tobytes()))
    assert packed_pieces(documents(spark, [])).collect() == []


def test_differencing_is_near_equal():
    rng = random.Random(3)
    for k in (1, 2, 7, 64):
        lengths = np.array([rng.randint(1, 500) for _ in range(12 * k)])
        window, fullest = packing.differencing(lengths, k)
        sums = np.bincount(window, lengths, minlength=k)
        assert sums.max() == fullest and sums.sum() == lengths.sum()
        assert sums.max() - sums.min() <= 60


def test_windows_rise_when_over_capacity():
    window = packing.near_equal_windows(np.array([60, 60, 60]), 100)
    assert sorted(window) == [0, 1, 2]
    window = packing.near_equal_windows(np.full(100, 470), 2048)
    assert np.bincount(window, np.full(100, 470)).max() <= 2048


def test_padding_is_small(spark):
    rng = np.random.default_rng(1)
    lengths = []
    while sum(lengths) < 100 * 2048:
        cuts = packing.piece_borders(int(rng.lognormal(6.3, 1.2)) + 1, packing.PIECE_TOKENS)
        lengths += [b - a for a, b in zip(cuts, cuts[1:])]
    window = packing.near_equal_windows(np.array(lengths), 2048)
    assert sum(lengths) / ((window.max() + 1) * 2048) > 0.97


TOXIC = ["vile", "rotten"]


def pipeline_rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(20, 90))), rng.choice("abc")) for i in range(150)]
    for i in range(0, 150, 5):
        words = rows[i][1].split()
        words[3], words[9] = TOXIC
        rows[i] = (i, " ".join(words), rows[i][2])
    rows += [(200 + i, rows[i][1].upper(), "a") for i in (1, 2, 3)]
    rows += [(300 + i, rows[i][1] + " tail", "b") for i in (6, 7, 8)]
    return rows + [rows[4], (400, None, "a"), (401, "", None), (402, "", None)]


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = pipeline_rows()
    documents(spark, rows, tmp_path / "documents.parquet").withColumn("note", F.lit(1)).write.parquet(str(tmp_path / "d" / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "d" / "labels.parquet"))
    folder = str(tmp_path / "d")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = workspace.materialise(stage(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "note"]
        kept.append([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    clean = [row for row in rows if not any(word in (row[1] or "").split() for word in TOXIC)]
    assert sorted(kept[0], key=repr) == sorted(clean, key=repr)
    # Of equal texts the largest doc_id stays.
    best = {}
    for row in clean:
        text = (row[1] or "").lower()
        best[text] = max(best.get(text, row), row, key=lambda r: r[0])
    assert sorted(kept[1], key=repr) == sorted(best.values(), key=repr)
    gone = {300 + i for i in (6, 7, 8) if any(row[0] == i for row in kept[1])}
    assert sorted(kept[2], key=repr) == sorted((row for row in kept[1] if row[0] not in gone), key=repr)
    # Every document comes as often as the mix takes it, nearly.
    mixed = {r["doc_id"]: r for r in mixing.mix(documents(spark, kept[2])).collect()}
    times = defaultdict(int)
    for row in kept[3]:
        times[row[0]] += 1
    for doc_id, row in mixed.items():
        assert times[doc_id] == (int(row["taken"] / row["size"] + 0.5) if row["size"] else 0)
    packed = corpus_pipeline.run(spark, folder).collect()
    windows_hold(packed, packing.CAPACITY)
    assert sum(p["length"] for p in packed) == sum(
        len(packing.encode(row[1] or "", packing.vocabulary_path())) for row in kept[3])


def test_pipeline_of_nothing(spark, tmp_path):
    folder = str(tmp_path)
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []

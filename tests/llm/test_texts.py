"""Scans, fingerprints, models and placement."""

import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from frames import awkward, clashing, documents, plain

from feedworks.llm import fingerprints, language, pii, queries, rows, secrets, sharding, toxicity, wordhash

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secrets_by_hand(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(spans)


def secret_rows():
    rng = random.Random(5)
    hexed = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [f"é\U0001f600 password={hexed(18)} and", f"TOKEN : '{hexed(9)}' x", "secret=abc", "password: token : abcdefgh",
            f"api_key=\"{hexed(6)}\" apikey={hexed(5)}", f"AKIA{'Q7' * 8} AKIAAKIA{'Z' * 11}", f"{hexed(24)} {hexed(23)}",
            f"passwd={hexed(40)}", f"token={hexed(30)}\npassword={hexed(30)}", "password==abcdef", "secret"]
    return rows + [f"plain words of an ordinary sentence number {i} identification internationalization" for i in range(40)]


def test_secrets_are_those_of_the_rules(spark, tmp_path):
    rows = [(i, text) for i, text in enumerate(secret_rows())] + [(None, None), (90, ""), (91, "x" * 60_000), (92, "a=b " * 20_000)]
    found = secrets.secrets(clashing(documents(spark, rows, tmp_path / "docs"))).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for row in found:
        base = [(s["start"], s["kind"], s["end"]) for s in row["spans"] if s["kind"] < 3]
        assert base == secrets_by_hand(texts[row["doc_id"]] or "")


def test_random_strings_are_found_by_their_characters(spark, tmp_path):
    rng = random.Random(6)
    pick = lambda chars, n: "".join(rng.choices(chars, k=n))
    every = string.ascii_letters + string.digits
    hidden = [pick(every, 24) for _ in range(10)] + [pick(string.ascii_uppercase + string.digits, 20) for _ in range(10)]
    rows = [(i, text) for i, text in enumerate(secret_rows())]
    rows += [(100 + i, f"something ordinary {value} identification") for i, value in enumerate(hidden)]
    rows += [(200, "internationalization-of-identification"), (201, "=" * 40), (202, "identificationinternationalization")]
    found = {row["doc_id"]: row["spans"] for row in secrets.secrets(documents(spark, rows, tmp_path / "docs")).collect()}
    for i, value in enumerate(hidden):
        assert [(s["start"], s["kind"], s["end"]) for s in found[100 + i]] == [(19, 3, 19 + len(value))]
    assert not found[200] and not found[201] and not found[202]


def test_secrets_of_nothing(spark):
    assert secrets.secrets(documents(spark, [])).collect() == []
    assert [row["spans"] for row in secrets.secrets(documents(spark, [(1, None)])).collect()] == [[]]


def test_personal_data_rules():
    assert pii.base_spans("mail a.b+c@x-y.example.com, 10.0.0.255 256.1.1.1 1.2.3.4.5") == [
        (0, 5, 26), (1, 28, 38), (1, 49, 56)]
    assert [s[0] for s in pii.base_spans("4111 1111 1111 1111, 4111111111111112 +1 (555) 123-4567 +12 34")] == [2, 3]
    assert pii.base_spans("") == []


def test_contexts_find_what_no_rule_names(spark, tmp_path):
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choices(string.digits, k=n))
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=6))
    rows = [(i, f"{word()} reach me at +1 (555) {digits(3)}-{digits(4)} {word()}") for i in range(30)]
    rows += [(100 + i, f"{word()} reach me at 555.{digits(3)}.{digits(4)} {word()}") for i in range(4)]
    rows += [(200 + i, f"{word()} chapter {digits(2)} of {word()} version {digits(1)}.{digits(1)}") for i in range(30)]
    rows += [(300 + i, text) for i, (_, text, *_) in enumerate(awkward(10))] + [(400, f"chapter {digits(2)} me at +1 555 1234567")]
    found = {row["doc_id"]: row["spans"] for row in pii.personal_data(clashing(documents(spark, rows, tmp_path / "docs"))).collect()}
    texts = dict(rows)
    assert len(found) == len(rows)
    for doc_id, spans in found.items():
        base = sorted(pii.base_spans(texts[doc_id] or ""))
        assert [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] < 4] == base
        added = [texts[doc_id][s["start"]:s["end"]] for s in spans if s["kind"] >= 4]
        assert added == ([texts[doc_id].split()[4]] if 100 <= doc_id < 200 else [])
    assert all(s["kind"] == 4 + 3 for i in range(4) for s in found[100 + i])


def test_personal_data_of_nothing(spark):
    assert pii.personal_data(documents(spark, [])).collect() == []


def test_edits_and_fingerprints(spark, tmp_path):
    rows = [(row[0], row[1]) for row in awkward(80, 10)]
    rng = random.Random(3)
    rows += [(1000 + i, " ".join("".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(100))) for i in range(300)]
    docs = clashing(documents(spark, rows, tmp_path / "docs"))
    known = sorted({row[0] for row in rows if row[0] is not None and sum(r[0] == row[0] for r in rows) == 1}, reverse=True)
    texts = {i: t or "" for i, t in rows}
    ordered = sorted((row for row in rows if row[0] is not None), key=lambda row: -row[0])
    found = fingerprints.compare_with_edits(docs).collect()
    assert len(found) == len(rows)
    by_text = {}
    for row in found:
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if row["doc_id"] in known and row["doc_id"] >= 1000:
            text = texts[row["doc_id"]]
            after = next(r[1] or "" for r in ordered if r[0] < row["doc_id"])
            half = len(text) // 2
            edit = text[:len(text) - half] + after[:half]
            assert row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
            assert row["n_chars"] == len(text)
            assert row["near_edited"] > 0.25 > row["near_next"]
            assert row["fingerprint"] == fingerprints.written(fingerprints.fingerprint(text))
            by_text.setdefault(row["fingerprint"], set()).add(text)
    assert all(len(group) == 1 for group in by_text.values())
    assert fingerprints.compare_with_edits(documents(spark, [])).collect() == []
    only = fingerprints.compare_with_edits(documents(spark, [(1, "alone " * 20)])).collect()
    assert only[0]["near_next"] == 1.0


def syncmers_by_hand(text, k=16, s=6):
    """Places of k-mers whose smallest s-mer stands at an edge, by the operator's own hash of s-mers."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    value = {}
    for i in range(len(codes) - s + 1):
        h = 0
        for c in codes[i:i + s]:
            letter = (int(c) + 1) * 0x9E3779B97F4A7C15 % 2 ** 64
            letter ^= letter >> 29
            h = (h * 0xD6E8FEB86659FD93 + letter) % 2 ** 64
        value[i] = int(wordhash.mix(np.array([h], np.uint64))[0])
    return [i for i in range(len(codes) - k + 1)
            if min(value[j] for j in range(i, i + k - s + 1)) in (value[i], value[i + k - s])]


def test_anchors_are_closed_syncmers(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdeé\U0001f600 ", k=700))
    places = sorted(fingerprints.anchors(text)[1].tolist())
    assert places == syncmers_by_hand(text)
    # Context-free: the same inside another text, and in parts.
    inside = sorted(fingerprints.anchors("XYZ" * 20 + text)[1].tolist())
    assert {p + 60 for p in places} <= set(inside)
    monkeypatch.setattr(fingerprints, "_CHARS", 50)
    assert sorted(fingerprints.anchors(text)[1].tolist()) == places


def test_likeness():
    one = fingerprints.fingerprint("the quick brown fox jumps over the lazy dog and more words follow here " * 3)
    assert fingerprints.likeness(one, one) == 1.0
    assert fingerprints.likeness([], []) == 1.0 and fingerprints.likeness(one, []) == 0.0
    assert fingerprints.fingerprint("short") != fingerprints.fingerprint("shirt")


def test_passages_shared_with_long_texts_are_matched():
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(n))
    passage, long, short = words(50), words(20_000), words(40)
    of_passage = {v for v, _ in fingerprints.fingerprint(passage)}
    inside, beside = (fingerprints.fingerprint(f"{text[:len(text) // 2]} {passage} {text[len(text) // 2:]}") for text in (long, short))
    assert len(of_passage) > 30 and len(inside) > 20_000
    for found in (inside, beside):
        assert of_passage <= {v for v, _ in found}
        assert [p for _, p in found] == sorted(p for _, p in found)
    assert fingerprints.likeness(inside, beside) >= 2 * len(of_passage) / (len(inside) + len(beside))
    # What stands after a change leaves the anchors before it.
    assert set(fingerprints.fingerprint(long)[:-20]) <= set(fingerprints.fingerprint(long + short))


def test_order_of_anchors_is_compared_in_full():
    rng = random.Random(13)
    for letters, n in [(2, 90), (5, 60), (400, 80), (1, 30)]:
        for _ in range(20):
            one, other = ([rng.randrange(letters) for _ in range(rng.randint(0, n))] for _ in range(2))
            row = [0] * (len(other) + 1)
            for value in one:
                row, before = row[:1], row
                for i, against in enumerate(other):
                    row.append(before[i] + 1 if value == against else max(row[i], before[i + 1]))
            assert fingerprints.common_in_order(one, other) == row[-1]


def toxic_rows(n, seed, words=("vile", "rotten", "filth")):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = rng.choices([f"w{j}" for j in range(500)], k=rng.randint(5, 300))
        toxic = i % 6 == 0
        for _ in range(3 * toxic):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)) if i % 2 == 0 else (i, None, None))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, tmp_path):
    rows, labels = toxic_rows(900, 1)
    labels += [(None, 1, 1), (0, 0, 0), (10 ** 9, 1, 1)]
    docs = clashing(documents(spark, rows + [(2000, None), (2001, ""), (None, rows[0][1]), (2002, rows[0][1])], tmp_path / "docs"))
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs, labelled).collect()
    assert len(found) == len(rows) + 4
    scores = {row["doc_id"]: row for row in found}
    held = [row for row in found if row["held_out"] and row["doc_id"] < 900]
    import zlib
    assert {r["doc_id"] for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(row["predicted"] == (row["doc_id"] % 6 == 0) for row in held)
    assert right / len(held) > 0.97
    assert all(row["predicted"] == int(row["score"] >= 0.7) for row in found)
    assert scores[2000]["score"] == scores[2001]["score"]
    assert scores[None]["score"] == scores[0]["score"] == scores[2002]["score"]


def test_labels_of_held_out_rows_are_not_learned(spark, tmp_path):
    rows, labels = toxic_rows(300, 2)
    docs = documents(spark, rows, tmp_path / "docs")
    import zlib
    schema = "doc_id long, quality int, toxic int"
    turned = [(i, q, 1 - t if t is not None and zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one = toxicity.toxicity(docs, spark.createDataFrame(labels, schema))
    other = toxicity.toxicity(docs, spark.createDataFrame(turned, schema))
    assert plain(one, "doc_id", "score") == plain(other, "doc_id", "score")


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [row["score"] for row in toxicity.toxicity(documents(spark, [(1, "a b")]), none).collect()] == [pytest.approx(0)]
    assert toxicity.toxicity(documents(spark, []), none).collect() == []


def test_risk_of_clean_documents_does_not_go_below_zero():
    rng = np.random.default_rng(0)
    # Toxic rows have features of their own each: learned by heart, the estimate would go negative.
    lists = [[int(x) for x in rng.integers(0, 200, 20)] for _ in range(120)]
    toxic = np.arange(120) < 40
    model = toxicity.fit(pa.array(lists, pa.list_(pa.int32())), toxic, np.ones(120, bool), 0.33)
    assert np.isfinite(model.weights).all() and np.isfinite(model.constant)


def test_words_of_a_chunk():
    texts = pa.array(["A b\tC", None, "", "a  b c", "xA", " A ", "b"])
    (first, last, data, offsets), = wordhash.chunks(texts)
    words = wordhash.Words(data, offsets)
    hashes = words.hashes()
    per_row = [hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
    assert [len(r) for r in per_row] == [3, 0, 0, 3, 1, 1, 1]
    assert per_row[0] == per_row[3] and per_row[5] == per_row[0][:1] and per_row[6] == per_row[0][1:2]
    assert per_row[4][0] not in per_row[0]


def test_chunks_cover_sliced_arrays(monkeypatch):
    monkeypatch.setattr(wordhash, "CHUNK_BYTES", 8)
    texts = pa.array(["zero", "one two", None, "a long text of many words", "", "x"]).slice(1)
    counts = []
    for first, last, data, offsets in wordhash.chunks(texts):
        words = wordhash.Words(data, offsets)
        counts += np.diff(words.first).tolist()
        assert last > first
    assert counts == [2, 0, 6, 0, 1]


def page(text, lang):
    declared = f' lang="{lang}"' if lang else ""
    return f"<html{declared}><head><title>x</title><script>var a='the and of';</script></head><body><p>{text}</p><!-- the --></body></html>"


def test_page_languages(spark, tmp_path):
    rng = random.Random(8)
    words = {"en": ["the", "and", "with", "which", "house"], "de": ["der", "und", "nicht", "schon", "haus"], "fr": ["le", "et", "avec", "maison", "dans"]}
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    docs = spark.createDataFrame([(i, text(lang, 30), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)] + [(999, "??", None)],
                                 "doc_id long, text string, lang string")
    rows, truth = [], {}
    for i in range(150):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, f"https://{lang}.example.{'com' if i % 2 else lang}/a/{i}", page(text(lang, 40), lang if i % 5 else "")))
        truth[i] = lang
    rows += [(500, "https://de.example.de/x", page("12345", "de")), (501, None, None), (502, "", ""), (503, "not a url", page(text("fr", 40), None)),
             (504, "https://de.example.de/y", page(text("fr", 60), "de"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {row["page_id"]: row for row in language.page_languages(pages, docs).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["lang"] == lang for i, lang in truth.items())
    assert found[500]["lang"] == "de"                       # host, suffix and markup speak for it
    assert found[504]["text_lang"] == "fr"
    assert found[501]["lang"] in words and 0 < found[501]["probability"] <= 1
    assert language.page_languages(pages.limit(0), docs).collect() == []
    assert {row["lang"] for row in language.page_languages(pages, docs.limit(0)).collect()} == {None}


def test_rare_languages_are_told_apart(spark):
    rng = random.Random(15)
    words = {f"l{i:02d}": ["".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(12)] for i in range(40)}
    text = lambda lang: " ".join(rng.choices(words[lang], k=40))
    # One language holds nearly everything, the others have four documents each.
    docs = spark.createDataFrame(
        [(i, text("l00"), "l00") for i in range(3000)] + [(5000 + i, text(lang), lang) for i, lang in enumerate(list(words)[1:] * 4)],
        "doc_id long, text string, lang string")
    languages, log_chance = language.train(docs, 200)
    assert languages == sorted(words)
    for lang in words:
        evidence = log_chance[:, language.trigrams(text(lang))].sum(axis=1)
        assert languages[int(evidence.argmax())] == lang


def test_samples_hold_rows_at_every_size(spark, monkeypatch):
    from pyspark.sql import functions as F

    key = F.xxhash64("id", F.lit(7))
    many = spark.range(20_000_000)
    assert 3 <= many.filter(rows.sampled(key, rows.hash_bound(15, 20_000_000))).count() <= 40
    few = spark.range(1000)
    assert few.filter(rows.sampled(key, rows.hash_bound(4000, 1000))).count() == 1000
    assert 350 < few.filter(rows.sampled(key, rows.hash_bound(500, 1000))).count() < 650
    assert rows.hash_bound(4000, 10 ** 13) > 0
    # An empty sample of rows that are there is an error.
    for module in (secrets, toxicity):
        monkeypatch.setattr(module, "hash_bound", lambda *_: -1)
    with pytest.raises(RuntimeError):
        secrets.log_ratios(documents(spark, [(1, "a b")]))
    with pytest.raises(RuntimeError):
        toxicity.train(documents(spark, [(i, "a b") for i in range(9)]), spark.createDataFrame(
            [(i, 1, 1) for i in range(9)], "doc_id long, quality int, toxic int"))


def test_table_is_shared_evenly_and_changes_little():
    names = [f"s{i}" for i in range(20)]
    full, less = sharding.fill_table(names, 2003), sharding.fill_table(names[:-1], 2003)
    held = Counter(full)
    assert set(held) == set(range(20)) and max(held.values()) - min(held.values()) <= 1
    moved = sum(a != b for a, b in zip(full, less) if a != 19)
    assert moved < 0.1 * 2003
    # A shard's slots are those of its own order that no earlier turn took.
    first, step = sharding.preference("s0", 2003)
    assert full[first] == 0 and step % 2003
    for wrong in ((names, 2004), ([], 2003), (names, 19)):
        with pytest.raises(ValueError):
            sharding.fill_table(*wrong)


def test_placement(spark, tmp_path):
    rows = awkward(30, 12)
    docs = clashing(documents(spark, rows, tmp_path / "docs"))
    found = sharding.place_documents(docs, [f"s{i}" for i in range(7)], 211).collect()
    table = sharding.fill_table([f"s{i}" for i in range(7)], 211)
    assert len(found) == len(rows)
    for row in found:
        assert row["shard"] == table[row["slot"]]
        if row["doc_id"] is not None:
            assert row["slot"] == int(hashlib.md5(str(row["doc_id"]).encode()).hexdigest()[:15], 16) % 211
    sharding.write_shards(documents(spark, rows), str(tmp_path / "out"), ["x", "y"], 211)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1}
    assert sharding.place_documents(documents(spark, [])).collect() == []


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", name).group(1)) for name in queries.QUERIES) == list(range(1, 14))

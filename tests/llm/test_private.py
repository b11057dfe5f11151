"""Personal data found by the rules, against the patterns as they are stated, and the whole query by hand."""

import hashlib
import random
import re
import time

import pytest
from frames import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from feedworks.llm import pii
from feedworks.llm.queries import op10_personal_data

# The patterns of the contract, and what their matches have to fulfil.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in doubled)) % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(part) <= 255 for part in match.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def by_hand(text):
    return [(kind, *m.span()) for kind, pattern in STATED.items() for m in re.finditer(pattern, text) if holds(kind, m.group())]


def found(text):
    return [(pii.KINDS[kind], start, end) for kind, start, end in pii.base_spans(text)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab1@.-_%+ é04", max_size=40))
def test_addresses(text):
    assert found(text) == by_hand(text)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "255", "256", "0", "00", ".", ".", ".", " ", "+", "-", "(", "4111111111111111", "a"]), max_size=20))
def test_numbers(parts):
    text = "".join(parts)
    assert found(text) == by_hand(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a.", "@", "a@", "a@b", "+1", "+1(", "1 ", "@a.", "a@b.c_"])
def test_long_runs_take_linear_time(unit):
    text = unit * (1_000_000 // len(unit))
    start = time.perf_counter()
    pii.base_spans(text)
    assert time.perf_counter() - start < 3


def test_query_by_hand(spark, tmp_path):
    rng = random.Random(4)
    known = ["anna@example.org", "10.0.0.1", "256.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+49 (30) 1234567", "+1 2",
             "x_y%z@a-b.co.uk", "1.2.3.4.5.6.7.8", "word", "é", "."]
    rows = [(i, " ".join(rng.choices(known, k=rng.randint(0, 12)))) for i in range(80)] + awkward(20)
    documents(spark, rows, tmp_path / "documents.parquet")
    result = op10_personal_data(spark, str(tmp_path)).collect()
    expected = []
    for row in rows:
        spans = by_hand(row[1] or "")
        digest = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        expected.append((row[0], *[sum(k == kind for k, _, _ in spans) for kind in STATED], hashlib.sha256(digest.encode()).hexdigest()))
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in result]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    base = [[s for s in r.spans.split(",") if s and not s.startswith("near_")] for r in result]
    assert [len(b) for b in base] == [r.n_email + r.n_ip + r.n_card + r.n_phone for r in result]


def added_by(spark, rows):
    """Per document the texts that contexts add, with their kinds."""
    texts = {row[0]: row[1] for row in rows}
    return {row["doc_id"]: [(pii.KINDS[s["kind"] - 4], texts[row["doc_id"]][s["start"]:s["end"]]) for s in row["spans"] if s["kind"] >= 4]
            for row in pii.personal_data(documents(spark, rows)).collect()}


def digits(rng, n):
    return "".join(rng.choices("0123456789", k=n))


def word(rng):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))


def planted(seed, hidden, shown="{w} call +1 (555) {a}-{b} {v}"):
    """Thirty texts with a phone number that the rules find, and four with one that they don't."""
    rng = random.Random(seed)
    make = lambda text: text.format(w=word(rng), v=word(rng), a=digits(rng, 3), b=digits(rng, 4))
    rows = [(i, make(shown)) for i in range(30)] + [(100 + i, make(hidden)) for i in range(4)]
    return rows + [(200 + i, f"{word(rng)} chapter {digits(rng, 2)} {word(rng)} 12 {digits(rng, 3)}") for i in range(30)]


@pytest.mark.parametrize("hidden, shown, pick", [
    ("{w} call ({a}) 555-{b} {v}", "{w} call +1 (555) {a}-{b} {v}", lambda t: t[t.index("(") + 1:].rsplit(" ", 1)[0]),
    ("{w} call {a} 555 {b} {v}", "{w} call +1 (555) {a}-{b} {v}", lambda t: t.split(" ", 2)[2].rsplit(" ", 1)[0]),
    ("{w} tel:555{b} {v}", "{w} tel:+1555{a}{b} {v}", lambda t: t.split(":")[1].split()[0]),
    ("{w} tel={a}.{b}, {v}", "{w} tel: +1555{a}{b} {v}", lambda t: t.split("=")[1].split(",")[0]),
    ("555.{a}.{b} evenings", "+1 (555) {a}-{b} evenings", lambda t: t.split()[0]),
])
def test_contexts(spark, hidden, shown, pick):
    """Values of several words, labels glued to them, and what only follows them."""
    rows = planted(len(hidden), hidden, shown)
    for doc_id, spans in added_by(spark, rows).items():
        assert spans == ([("phone", pick(dict(rows)[doc_id]))] if 100 <= doc_id < 200 else [])


def test_found_values_are_seeds_in_turn(spark):
    """Values found beside a word that rules know stand beside another word, too, and that word
    beside further values."""
    rng = random.Random(8)
    rows = [(i, f"{word(rng)} call +1 (555) {digits(rng, 3)}-{digits(rng, 4)} {word(rng)}") for i in range(40)]
    found = [f"555.{digits(rng, 3)}.{digits(rng, 4)}" for _ in range(8)]
    rows += [(100 + i, f"{word(rng)} call {value} {word(rng)}") for i, value in enumerate(found)]
    rows += [(200 + i, f"{word(rng)} hotline {value} {word(rng)}") for i, value in enumerate(found * 2)]
    further = [f"555-{digits(rng, 3)}{digits(rng, 4)}" for _ in range(3)]
    rows += [(300 + i, f"{word(rng)} hotline {value} {word(rng)}") for i, value in enumerate(further)]
    spans = added_by(spark, rows)
    assert [spans[300 + i] for i in range(3)] == [[("phone", value)] for value in further]
    assert all(spans[i] == [] for i in range(40)) and all(len(spans[100 + i]) == 1 for i in range(8))


def test_rows_of_numbers_are_no_identifiers():
    text = "call " + " ".join(str(i) for i in range(100, 2000))
    places = [(start, end) for kind, start, end, *_ in pii.occurrences(text) if kind < 0]
    assert len(places) == 1900 and all(" " not in text[s:e] for s, e in places)

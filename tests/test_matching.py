"""Shared blocks against the plain matcher, and their time."""

import random
import time
from difflib import SequenceMatcher

import pytest

from storyloom.functions import fuzzy, matching


def plain(a, b, least):
    return [(m.a, m.b, m.size) for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size >= least and m.size]


def mixed(rng, n, of):
    return "".join(rng.choice(of) for _ in range(n))


@pytest.mark.parametrize("pairs", [1 << 21, 0])  # by runs, and all by the automaton
def test_blocks_are_the_plain_matchers(monkeypatch, pairs):
    monkeypatch.setattr(matching, "PAIRS", pairs)
    rng = random.Random(7)
    for _ in range(300):
        of = rng.choice(["ab", "abc ", "abcdefghijklmnopqrstuvwxyz ", "的一是不了", "a"])
        least = rng.choice([1, 2, 4, 10])
        a = mixed(rng, rng.randint(0, 200), of)
        b = mixed(rng, rng.randint(0, 200), of)
        for _ in range(rng.randint(0, 4)):
            s = rng.randint(0, len(a))
            b = b[: rng.randint(0, len(b))] + a[s : s + rng.randint(0, 60)] + b[rng.randint(0, len(b)) :]
        if rng.random() < 0.2:
            b = a
        assert matching.shared_blocks(a, b, least) == plain(a, b, least)


def test_texts_of_the_tables():
    import duckdb

    texts = [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where text is not null order by doc_id").fetchall()]
    rng = random.Random(1)
    for _ in range(150):
        a, b = (rng.choice(texts)[:3000] for _ in range(2))
        cut = rng.randint(0, len(a))
        b = b[: len(b) // 2] + a[cut : cut + 500] + b[len(b) // 2 :]
        assert matching.shared_blocks(a, b, 10) == plain(a, b, 10)


@pytest.mark.parametrize("kind", ["prose", "copies", "one character", "periods"])
def test_a_hundred_kilobytes_take_little_time(kind):
    rng = random.Random(3)
    words = [mixed(rng, rng.randint(2, 9), "abcdefghijklmnopqrstuvwxyz") for _ in range(2000)]
    text = lambda: " ".join(rng.choice(words) for _ in range(17_000))[:100_000]
    a = {"prose": text(), "copies": text(), "one character": "a" * 100_000, "periods": "ab-" * 33_000}[kind]
    b = {"prose": text(), "copies": a[:40_000] + "x" + a[40_100:90_000] + text()[:9000], "one character": "a" * 99_000, "periods": "-ab" * 33_000}[kind]
    began = time.perf_counter()
    found = matching.shared_blocks(a, b, 10)
    assert time.perf_counter() - began < (1 if kind in ("prose", "copies") else 3)
    assert found or kind == "prose"


def test_repeated_spans(spark):
    long = "x" * 300 + " The house rules are these: be kind, be brief. " + "y" * 300
    assert fuzzy.repeated_intervals("Hello. The house rules are these: be kind, be brief. Bye", [long, "nothing"]) == [(6, 53)]
    assert fuzzy.repeated_intervals("short", ["short"]) == []

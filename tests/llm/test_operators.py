import math
import random
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc as orc
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storyloom.llm import components, decontam, htmltext, neardup, packing, pii, pretok, quality, sharding, subdedup, tokencount, tokenout
from storyloom.llm.queries import vocabulary
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, seed long, ctx string, runs string, spans string, bands string, key string, slot long, part string"
WORDS = "the of and in to a is it for on was with that by from rest onth tion able ness".split()


def prose(rng, n, vocab=None):
    vocab = vocab or [a + b for a in WORDS for b in ["", "er", "ly", "ing"]]
    return " ".join(rng.choice(vocab) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


def corpus(seed=1):
    """Random texts, copies, near copies, shared passages, periodic texts and odd cases."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 260)) for _ in range(40)]
    passage = prose(rng, 60)
    texts = [*base, *base[:6], base[0]]
    for t in base[:14]:
        w = t.split(" ")
        for _ in range(max(1, len(w) // 60)):
            w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [f"{t} {passage} {rng.choice(base)}" for t in base[20:28]]
    texts += ["Der " * 300, "Der " * 40, "a b " * 90, "x\ny\n" * 60, "", " \n\t", None, None, "one two", "One  TWO", "one two three four five", "é è ü " * 30, "1\x0b2\x1f3 4 5 6 7", "w" * 30_000, "9" * 30_000 + " " + "1 2 " * 8000]
    texts += [" ".join(f"u{i}" for i in range(5000))] * 2
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, base[3]), (None, None), (7, base[7])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "c", "r", "p", "b", "k", 5, "q") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(rows):
    return sorted(tuple(map(repr, r)) for r in rows)


def test_substring_dedup(docs, rows, none):
    got = subdedup.remove_repeats(docs).collect()
    assert key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == key(brute.substring_dedup(rows))
    assert subdedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize(("size", "seed"), [(8, 3), (5, 5), (12, 2)])
def test_substring_dedup_of_other_lengths(spark, size, seed):
    rng = random.Random(size)
    rows = [(i, prose(rng, rng.randint(0, 120), WORDS[:4])) for i in range(60)]
    got = subdedup.remove_repeats(frame(spark, rows), min_words=size, seed_words=seed).collect()
    assert key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == key(brute.substring_dedup(rows, size))


def test_near_duplicates(docs, rows, none):
    got = neardup.near_duplicates(docs).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == key(brute.near_duplicates(rows))
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicates_in_a_large_group_with_blocks(spark):
    """One base text with 0 to 4 edits in each of 150 copies: links hold for some pairs only."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(1000)}" for _ in range(110)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(110)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(frame(spark, rows), block=32).collect()
    assert key((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == key(brute.near_duplicates(rows))


def test_rows_dealt_to_blocks_follow_the_members_of_a_large_group(spark, monkeypatch):
    """700 copies with 0 to 4 edits each: a member is dealt some four times, not once for each few hundred others."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(1000)}" for _ in range(110)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(110)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    seen, tasks = [], neardup._tasks
    monkeypatch.setattr(neardup, "_tasks", lambda r, *a, **k: seen.append((r.count(), (out := tasks(r, *a, **k)).count())) or out)
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert len(seen) == 2 and seen[0][0] > 256 and all(dealt <= 4 * n for n, dealt in seen)
    assert key((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == key(brute.near_duplicates(rows))


def test_blocks_of_long_texts_hold_their_sets_within_bytes(spark):
    long = neardup.BYTES // 8 // 10
    rows = spark.range(100).select(F.lit("p").alias("place"), F.lit(None).cast("long").alias("key"), F.col("id").cast("string").cast("binary").alias("digest"), F.lit(long).cast("long").alias("n"), F.col("id").cast("string").cast("binary").alias("comp"))
    texts = lambda **k: neardup._tasks(rows, 85, neardup.BLOCK, **k).where("lo = hi").groupBy("cell", "lo").count().agg(F.max("count")).first()[0]
    assert texts() == 99 and texts(full=True) < 30


def test_near_duplicates_of_ids_with_several_texts(spark):
    rng = random.Random(12)
    near = lambda t: " ".join("edited" if i == 30 else w for i, w in enumerate(t.split(" ")))
    a, b, c, d, e, f, g, h = (prose(rng, 150) for _ in range(8))
    rows = [(10, a), (10, b), (11, near(a)), (12, near(b)), (20, c), (20, None), (21, near(c)), (30, d), (30, ""), (31, near(d)), (40, e), (41, e), (41, f), (42, near(f)), (50, g), (51, g), (60, h), (61, h), (61, g), (61, None)]
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    want = brute.near_duplicates(rows)
    assert key((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == key(want)
    assert {(10, 10), (11, 10), (12, 10), (21, 20), (31, 30), (42, 40), (61, 50)} <= {(i, k) for i, _, k, _ in want}


def test_sets_of_one_id_stay_apart(spark):
    rng = random.Random(13)
    for _ in range(3):
        texts = [prose(rng, 120) for _ in range(6)]
        near = [" ".join(w if i != 40 else "edited" for i, w in enumerate(t.split(" "))) for t in texts]
        rows = [(1, t) for t in texts] + [(2 + i, t) for i, t in enumerate(near)]
        got = neardup.near_duplicates(frame(spark, rows)).collect()
        assert {r.component_id for r in got} == {1}


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: find(x) for x in list(up)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def library(name):
    return Tokenizer.from_file(vocabulary(name))


def test_packing(docs, rows, none):
    lib = library("word_bpe_49k.json")
    want = sorted((repr(d), [*lib.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows)
    got = packing.pack(docs, vocabulary("word_bpe_49k.json"), windows=8).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    by_doc = {}
    for r in got:
        by_doc.setdefault((repr(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    whole = {}
    for d, ids in want:
        whole.setdefault((d, len(ids)), []).append(ids)
    assert set(whole) == set(by_doc)
    for k, pieces in by_doc.items():
        texts = whole[k]
        options = {(s, n, brute.crc(ids[s : s + n])) for ids in texts for s, n, _ in pieces}
        assert set(pieces) <= options
        assert sum(n for _, n, _ in pieces) == sum(map(len, texts))
    assert packing.pack(none, vocabulary("word_bpe_49k.json")).count() == 0


def test_differencing_is_near_equal():
    rng = random.Random(2)
    lengths = [rng.randint(1, 512) for _ in range(300)]
    slots = packing.difference(lengths, 40)
    sums = [sum(lengths[i] for i in s) for s in slots]
    assert sorted(i for s in slots for i in s) == list(range(300))
    assert max(sums) - min(sums) <= 40
    assert all(sum(lengths[i] for i in s) <= 2048 for s in packing.windows_for(lengths, 2048))
    assert packing.difference([], 3) == [[], [], []]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts(docs, rows, none, name):
    lib = library(name)
    got = tokencount.token_counts(docs, vocabulary(name)).collect()
    want = [(d, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t in rows]
    assert key((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == key(want)
    assert tokencount.token_counts(none, vocabulary(name)).count() == 0


def odd_texts():
    rng = random.Random(3)
    pool = list(" \n\t'aAsStTrevVlLmMdD09.,!é ''  <|x$")
    trusted = [chr(c) for a, b in pretok._COMMON for c in range(a, b)]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", "a<|endoftext|>b <|startoftext|>", "日本語 テスト 😀 x", "ΣΑΣ İ x", "é x", "\x1c \x1d"]
    return texts + [f"a{c}b {c} {c}{c} 9{c}\n{c}" for c in rng.sample(trusted, 3000)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_and_merger_match_the_library(name):
    texts = odd_texts()
    ids, count = pretok.Encoder(vocabulary(name)).encode(pa.array(texts))
    edge = np.concatenate([[0], np.cumsum(count)])
    n = tokencount.counts(vocabulary(name), pa.array(texts))
    for i, w in enumerate(library(name).encode_batch(texts, add_special_tokens=False)):
        assert ids[edge[i] : edge[i + 1]].tolist() == w.ids, repr(texts[i])
        assert n[i] == len(w.ids), repr(texts[i])


def test_quality(docs, rows, none, spark):
    got = quality.quality_report(docs).collect()
    assert key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == key((d, *brute.quality(t)) for d, t in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.quality_report(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert key((r.doc_id, r.text) for r in kept.collect()) == key(({r.doc_id: 1 for r in got} and (d, t)) for d, t in rows if any(r.kept and r.doc_id == d and r.n_words == len(brute.words(t)) for r in got))


def test_the_verdict_is_the_plain_one(docs, rows, spark):
    """Whole verdicts, by default and fitted limits, against a loop over texts."""
    z = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False)
    share = lambda b: len(z.compress(b)) / len(b)
    labels = spark.createDataFrame([(d, int(i % 3 > 0), 0) for i, (d, _) in enumerate(rows)] + [(10**6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")

    def plain(text, bands, chunk):
        raw = (text or "").encode()
        if brute.quality(text)[-1]:
            return False
        own = [b for b in bands if b[0] <= len(raw)]
        if own and not own[-1][1] <= share(raw) <= own[-1][2]:
            return False
        cuts = [raw[i : i + 4096] for i in range(0, len(raw), 4096)] if len(raw) >= 4096 else []
        if cuts and len(cuts[-1]) < 4096:
            cuts[-1] = raw[-4096:]
        return all(chunk[0] <= share(c) <= chunk[1] for c in cuts)

    for known in (None, labels):
        bands, chunk = quality.fit_bands(docs, labels, least=5) if known is not None else (quality.BANDS, quality.CHUNK_BAND)
        got = quality.quality_report(docs, limits=(bands, chunk)).collect()
        assert key((r.doc_id, r.n_words, r.kept) for r in got) == key((d, len(brute.words(t)), plain(t, bands, chunk)) for d, t in rows)
    assert bands != quality.BANDS


def test_bands_reject_repetitive_and_incompressible(spark):
    rng = random.Random(6)
    noise = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(76)) for _ in range(60))
    lines = "\n".join(f"item {i} of the list is the same as item {i + 1} of the list, as before" for i in range(80))
    good = [(i, prose(rng, 400, [prose(rng, 1) + str(rng.randrange(999)) for _ in range(800)])) for i in range(3)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_report(frame(spark, [*good, (10, noise), (11, lines)])).collect()}
    assert got[10] == (False, False)
    assert not got[11][1]
    assert all(got[i][1] for i in range(3))


def test_short_random_texts_are_incompressible(spark):
    rng = random.Random(8)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    sizes = range(200, 1001, 20)
    block = lambda n: "".join(rng.choice(signs + "+/") for _ in range(n))
    mixed = lambda n: " ".join("".join(rng.choice(signs) for _ in range(rng.randint(3, 10))) for _ in range(n))[:n]
    noise = [(i, f(n)) for i, (n, f) in enumerate((n, f) for n in sizes for f in (block, mixed))]
    vocab = [prose(rng, 1) + str(rng.randrange(999)) for _ in range(800)]
    good = [(1000 + i, prose(rng, rng.randint(25, 90), vocab)) for i in range(600)]
    docs = frame(spark, [*noise, *good])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    for known in (None, labels):
        kept = {r.doc_id for r in quality.quality_report(docs, known).where("kept").collect()}
        assert not kept & {i for i, _ in noise}
        assert len(kept & {i for i, _ in good}) > 0.98 * len(good)
    high = [b[2] for b in quality.fit_bands(docs, labels)[0]]
    assert any(h < b[2] for h, b in zip(high, quality.BANDS, strict=True)) and all(h <= b[2] for h, b in zip(high, quality.BANDS, strict=True))


def test_the_end_of_a_text_is_judged_like_its_start(spark):
    rng = random.Random(9)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    vocab = [prose(rng, 1) + str(rng.randrange(999)) for _ in range(800)]
    good = [prose(rng, 2000, vocab)[: quality.CHUNK] for _ in range(2)]
    junk = " ".join("".join(rng.choice(signs) for _ in range(rng.randint(3, 10))) for _ in range(2000))[: quality.CHUNK - 6]
    texts = [good[0] + junk, junk + good[0], good[0] + good[1][:4000], good[0], good[0][:-1]]
    got = {r.doc_id: r for r in quality.quality_report(frame(spark, [*enumerate(texts)])).collect()}
    assert [got[i].kept for i in range(5)] == [False, False, True, True, True]
    assert got[0].max_chunk > quality.CHUNK_BAND[1]
    assert got[3].min_chunk == got[3].max_chunk and got[4].min_chunk is None
    for n in (0, 4095, 4096, 4097, 8191, 8192, 8193, 20000):
        seen = {j for i in quality.chunk_starts(n) for j in range(i, i + quality.CHUNK)}
        assert seen == (set(range(n)) if n >= quality.CHUNK else set())


def benchmark(rng, n=12):
    return [(i, prose(rng, rng.randint(14, 40), [f"{a}{b}" for a in WORDS for b in "klmnop"])) for i in range(n)]


def test_passages_at_any_start(spark):
    rng = random.Random(14)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    item = letters(200, "abcdefghijkl")
    texts = []
    for start in range(60, 72):
        cut = list(item[start : start + 64])
        for k in (12, 25, 38, 51):
            cut[k] = "z"
        texts.append(letters(100, "mnopqrst") + "".join(cut) + letters(100, "mnopqrst"))
    got = decontam.contaminated(frame(spark, [*enumerate(texts)]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [(i, 7, 4) for i in range(12)]
    assert decontam.decontaminate(frame(spark, [*enumerate(texts)]), spark.createDataFrame([(7, item)], "item_id long, text string")).count() == 0


def test_passages_of_any_alphabet_and_period():
    rng = random.Random(21)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    plain = lambda x: "".join(map(chr, decontam.normal(*decontam.flat(pa.array([x])))[0].tolist()))
    for _ in range(16):
        of = rng.choice(["ab", "abcdef", "-= ", "abcdefghijklmnop", "的一是不了人我在有他这", "éüßçñ a", "\U0001f600\U0001f601ab"])
        items = [letters(rng.randint(5, 300), of) for _ in range(4)] + ["-" * rng.randint(20, 900), "=-" * rng.randint(20, 400)]
        texts = []
        for _ in range(10):
            item = rng.choice(items)
            at = rng.randrange(len(item))
            cut = list(item[at : at + rng.randint(40, 120)])
            for _ in range(rng.randint(0, 6)):
                q = rng.randrange(len(cut) + 1)
                cut[q : q + rng.randint(0, 1)] = rng.choice(["", "z"])
            texts.append(letters(rng.randint(0, 200), "uvwxyz" + of) + "".join(cut) + letters(rng.randint(0, 200), "uvwxyz"))
        known = [(j, x) for j, x in enumerate(plain(i).strip() for i in items) if len(x) >= decontam.Q]
        index = decontam.Index([([j], x.encode()) for j, x in known], 64)
        want = {(i, j) for i, t in enumerate(map(plain, texts)) for j, x in known for n in [min(64, len(x))] if any(brute.within(x[s : s + n], t, decontam.budget(n)) for s in range(len(x) - n + 1))}
        assert {(g[0], index.ids[g[1]][0]) for g in index.search(pa.array(texts))} == want


def test_a_passage_is_counted_in_characters(spark):
    rng = random.Random(31)
    letters = lambda n, low=0x4E00: "".join(chr(low + rng.randrange(5000)) for _ in range(n))
    item = letters(300)
    rows = [(n, letters(50) + item[100 : 100 + n] + letters(50)) for n in (20, 22, 40, 59, 64, 80)]
    for start in range(0, 236, 7):
        cut = list(item[start : start + 64])
        for k in (9, 25, 41, 57):
            cut[k] = "x"
        rows.append((1000 + start, letters(30) + "".join(cut) + letters(30)))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    want = {64, 80, *(d for d, _ in rows if d >= 1000)}
    assert {r.doc_id for r in decontam.contaminated(frame(spark, rows), bench).collect()} == want
    assert {r.doc_id for r in decontam.decontaminate(frame(spark, rows), bench).collect()} == {20, 22, 40, 59}
    # an item in pieces: cut at characters, at every start
    many = decontam.contaminated(frame(spark, rows), bench, block_bytes=400, group_bytes=900)
    assert {r.doc_id for r in many.collect()} == want


def test_blocks_are_read_one_by_one(spark):
    rng = random.Random(32)
    bench = spark.createDataFrame([(i, prose(rng, 40)) for i in range(40)], "item_id long, text string")
    docs = frame(spark, [(i, prose(rng, 50)) for i in range(20)]).withColumn("digest", F.lit("own"))
    kept = decontam.decontaminate(docs, bench, block_bytes=600, group_bytes=2400)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and kept.columns == docs.columns and kept.count() == 20


def test_long_repetitions_take_little_memory():
    tracemalloc.start()
    index = decontam.Index([([1], b"-" * 10_000), ([2], b"=-" * 3000)], 64)
    got = index.search(pa.array(["-" * 100_000, "x" + "-" * 700_000 + "=-" * 200, "ab " * 50_000]))
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert [(r, index.ids[i], e) for r, i, e, *_ in got] == [(0, [1], 0), (1, [1], 0), (1, [2], 0)]
    assert all(0 <= g[3] < g[4] for g in got) and got[0][4] <= 100_000


def test_items_without_an_id_and_other_columns(spark):
    rng = random.Random(22)
    text = prose(rng, 60)
    bench = spark.createDataFrame([(None, text, 1, "x"), (-1, text, 2, "y"), (3, text, 3, "z"), (3, text, 3, "z")], "item_id long, text string, doc_id long, edits string")
    docs = frame(spark, [(1, f"a b c {text}"), (None, text), (2, prose(rng, 60)), (1, f"a b c {text}")])
    got = sorted(((r.doc_id or 0, r.item_id) for r in decontam.contaminated(docs, bench).collect()), key=repr)
    assert got == sorted([(i, j) for i in (0, 1, 1) for j in (None, -1, 3, 3)], key=repr)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_decontamination(spark, rows, none):
    rng = random.Random(11)
    items = [*benchmark(rng), (90, None), (91, ""), (92, "short")]
    texts = [t[:500] for _, t in rows[:20]]
    planted = []
    for k in range(24):
        item = items[k % 12][1]
        cut = item[rng.randrange(0, max(1, len(item) - 70)) :][: 70 if k % 2 else 400]
        chars = list(cut)
        for _ in range((0, 2, 4, 9)[k % 4]):
            chars[rng.randrange(len(chars))] = rng.choice("xyz")
        planted.append(f"{rng.choice(texts)[:300]} {''.join(chars).upper() if k % 3 == 0 else ''.join(chars)} {rng.choice(texts)[:300]}")
    table = [*((i, t[:500]) for i, t in rows[:20]), *((100 + i, t) for i, t in enumerate(planted)), (None, items[0][1]), (300, None), (301, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def plain(t):
        return " ".join(brute.words((t or "").translate(brute.LOWER))) if t else ""

    want = set()
    for d, t in table:
        text = plain(t)
        for i, x in items:
            item = plain(x)
            if len(item) < decontam.Q or not text:
                continue
            size = min(64, len(item))
            if any(brute.within(item[s : s + size], text, decontam.budget(size)) for s in range(len(item) - size + 1)):
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(frame(spark, table), bench).collect()}
    assert got == want
    assert len(want) >= 18
    for group in (400, 2000):  # several blocks, behind the bit tables of several groups
        assert {(r.doc_id, r.item_id) for r in decontam.contaminated(frame(spark, table), bench, block_bytes=400, group_bytes=group).collect()} == want
        assert {r.doc_id for r in decontam.decontaminate(frame(spark, table), bench, block_bytes=400, group_bytes=group).collect()} == {d for d, _ in table} - {d for d, _ in want}
    kept = decontam.decontaminate(frame(spark, table), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in table} - {d for d, _ in want}
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(frame(spark, table), bench.limit(0)).count() == 0


def test_token_ids(docs, rows, none, spark, tmp_path):
    lib, path = library("byte_bpe_50k.json"), f"file://{tmp_path}/ids"
    tokenout.write_token_ids(docs, path, vocabulary("byte_bpe_50k.json"), partitions=4)
    got = sorted(tokenout.manifest(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r, (d, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")), strict=True):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), brute.crc(ids))
        at += len(ids)
    one = next((tmp_path / "ids").glob("part-*.orc"))
    assert orc.ORCFile(one).schema.names == ["doc_id", "part", "local_start", "n_tokens", "ids"]
    assert spark.read.schema(tokenout.FILE_DDL).orc(path).where("doc_id = 5").count() == 1
    tokenout.write_token_ids(none, f"{path}2", vocabulary("byte_bpe_50k.json"))
    assert tokenout.manifest(spark, f"{path}2").count() == 0


def test_orc_metadata_prunes(spark, tmp_path):
    """Stripes, row indexes and Bloom filters are in the files, and a lookup reads few rows by them."""
    rows = [(3 * i, f"text number {i} of many") for i in range(20_000)]
    path = f"file://{tmp_path}/ids"
    tokenout.write_token_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, vocabulary("byte_bpe_50k.json"), partitions=2, stride=1000, stripe_bytes=64 << 10)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for one in (tmp_path / "ids").glob("part-*.orc"):
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(str(one)), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getStripes().size() > 1 and reader.getRowIndexStride() == 1000
        kinds = {str(s.getKind()) for s in reader.rows().readStripeFooter(reader.getStripes().get(0)).getStreamsList()}
        assert "ROW_INDEX" in kinds and kinds & {"BLOOM_FILTER", "BLOOM_FILTER_UTF8"}
        encodings = {str(c.getKind()) for c in reader.rows().readStripeFooter(reader.getStripes().get(0)).getColumnsList()}
        assert "DIRECT_V2" in encodings  # run-length encoded integers

    def read_for(condition):
        df = tokenout.read_token_ids(spark, path).where(condition)
        found = df.count()
        metrics = df.select("doc_id")
        metrics.collect()
        scan = metrics._jdf.queryExecution().executedPlan().collectLeaves().head()
        return found, scan.metrics().apply("numOutputRows").value()

    found, read = read_for("doc_id = 30000")
    assert found == 1 and 0 < read <= 1000
    assert read_for("doc_id = 30001") == (0, 0)  # inside the range, not in the Bloom filter
    assert read_for("doc_id >= 0") == (20_000, 20_000)


def test_sharding(spark, docs, none):
    size, shards = 1009, 10
    table = sharding.lookup_table(shards, size)
    counts = [table.count(i) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    # turn by turn, by the rule itself
    at = [sharding._number(str(i), "offset") % size for i in range(shards)]
    skip = [sharding._number(str(i), "skip") % (size - 1) + 1 for i in range(shards)]
    plain, turn = {}, 0
    while len(plain) < size:
        i = turn % shards
        j = next(j for j in range(size) if (at[i] + j * skip[i]) % size not in plain)
        plain[(at[i] + j * skip[i]) % size] = i
        turn += 1
    assert tuple(plain[s] for s in range(size)) == table
    moved = sum(a != b for a, b in zip(table, sharding.lookup_table(shards + 1, size), strict=True))
    assert moved < size / 2
    got = sharding.place(docs, "doc_id", shards, size).collect()
    assert len(got) == docs.count()
    assert all(r.shard == table[r.slot] for r in got)
    assert sharding.place(none).count() == 0
    with pytest.raises(ValueError, match="prime"):
        sharding.lookup_table(3, 10)


PAGE = """<!DOCTYPE html><html><head><title>T x</title><script>var a = "<p>no</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b>ly   said&nbsp;so.</p><aside>see also this</aside><!-- no --><p>Second<br>line &lt;ok&gt; &#233;.</p></article>
<section id="comments"><p>First! Great post by me</p></section><form><input><label>Mail</label></form><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    weights = htmltext.fit_weights([PAGE] * 3)
    assert htmltext.extract(PAGE, weights) == "A & B First boldly said so. Second line <ok> é."
    assert all(v < 0 for v in weights.values())
    for page in ("", None, "<", "<p", "<nav>", "&am", "<article>cut &am", "<div class='ad'>x<article>y z"):
        assert isinstance(htmltext.extract(page, weights), str)
    assert htmltext.extract("<article>cut &am", weights) == "cut &am"
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in htmltext.main_text(df).collect()))
    assert got[0] == (0, "", 0) and got[1][1] == got[2][1] and got[3] == (2, "", 0)
    assert got[1][2] == len(got[1][1])
    assert htmltext.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("middle", "shown"),
    [
        ('<svg class="i"/>', ""),
        ("<math />", ""),
        ('<svg class="nav"><svg/><title/><path d="M0 0"></svg>', ""),
        ("<svg><g><path>", ""),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x = 2"),
        ("<svg>" + "<path/>" * 90 + "<text>label</text></svg>", "label"),
        ("<video controls><source src=x>", ""),
        ("<object data=x><p>fallback</p></object>", "fallback"),
        ("<audio>", ""),
        ("<canvas>", ""),
        ("<select><option>red<option>blue", ""),
        ("<select><option>red</option></select>", ""),
        ("<script>var a = '<p>';</script><style>p {}</style>", ""),
        ("<template><p>later</p></template><iframe src=x></iframe>", ""),
    ],
)
def test_html_after_drawings_formulas_and_media(middle, shown):
    first, second = "one two three four five six seven", "eight nine ten eleven twelve thirteen fourteen"
    page = f"<html><body><article><p>{first}</p>{middle}<p>{second}</p></article><footer>end</footer></body></html>"
    assert htmltext.extract(page, {}) == " ".join(f"{first} {shown} {second}".split())


VARIED = [
    # a blog: content in a div, links inside it, comments behind
    ("""<html><head><title>t</title></head><body><div id="top-nav" class="navbar"><a href=/>Home</a> <a href=/a>About us and more</a></div><div class="wrapper"><div class="post-body">
<h1>On rivers</h1><p>The <a href="/r">river</a> runs from the <a href="/h">hills</a> down to the sea, slowly and then at once.</p><div class="advert">Buy boots now, half price today only for you</div>
<p>It is <em>old</em>, older than the towns on its banks.</p></div><div class="comments"><div class="comment"><p>I love this river so much, thank you for the post about it!</p></div></div></div><div class="footer-links">All rights reserved by the owners of this site</div></body></html>""",
     "On rivers The river runs from the hills down to the sea, slowly and then at once. It is old, older than the towns on its banks."),
    # a header inside the article, an aside with a role, a list
    ("""<body><header role="banner">The Daily Paper of Records</header><main><article><header><h1>Steps to follow</h1></header><ol><li>Open the lid with both of your hands.</li><li>Pour the water in without haste.</li></ol>
<aside class="related">Read also: how to close a lid</aside><p>That is all there is to it.</p></article></main><footer>(c)</footer></body>""",
     "Steps to follow Open the lid with both of your hands. Pour the water in without haste. That is all there is to it."),
    # tables and code, unbalanced quotes, an attribute with a greater-than sign
    ("""<body><nav><ul><li><a href=x>One</a></li></ul></nav><section><h2 title="a > b">Figures of the year</h2><table><tr><td>alpha</td><td>12</td></tr><tr><td>beta</td><td>34</td></tr></table><p data-x='"'>All of them were counted twice, by two people who did not meet.</p></section>
<div class=cookie-consent>We value your privacy, accept all cookies or leave</div></body>""",
     "Figures of the year alpha 12 beta 34 All of them were counted twice, by two people who did not meet."),
    # no markup but paragraphs
    ("<p>Only a line &amp; nothing else.", "Only a line & nothing else."),
    # a form, a script and a hidden element inside the content
    ("""<body><div class="sidebar"><p>Popular posts of this week for all of our readers</p></div><div class="entry"><p>First things come first, as they say in the old books.</p><form><p>Leave your mail address here</p><input></form>
<div style="display:none">secret words for machines</div><script>if (a < b) { x("<p>no</p>") }</script><p>Second things come second.</p></div><div class="share-buttons"><a>Share</a> <a>Tweet</a></div></body>""",
     "First things come first, as they say in the old books. Second things come second."),
]


def test_html_of_other_templates(spark):
    """Pages of other hands than the tables': without any fit, and with what the tables' pages taught."""
    fitted = htmltext.fit_weights([r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()])
    for page, text in VARIED:
        assert htmltext.extract(page, {}) == text
        assert htmltext.extract(page, fitted) == text


def test_class_words_are_learned():
    page = '<body><div class="zig {0}"><p>{1} this stands outside of it all</p></div><article><div class="zag"><p>{1} inside {1} and more words follow here</p></div></article></body>'
    weights = htmltext.fit_weights([page.format(f"x{i}", f"word{i}") for i in range(30)])
    assert weights[".zig"] < -htmltext.COST / 2 < weights[".zag"]
    other = '<body><div class="zig"><p>one two three four five six seven eight nine ten eleven</p></div><div class="zag"><p>a b c d e f</p></div></body>'
    assert htmltext.extract(other, weights) == "a b c d e f"
    # the labelled pages outvote the lists
    kept = htmltext.fit_weights([f"<article><div class='comment'><p>{i} said</p></div></article>" for i in range(30)])
    few = (3, 0, 0, 100)
    assert htmltext.judged("div", " class='comment'", kept, size=few) == htmltext.PLAIN and htmltext.judged("div", " class='comment'", {}, size=few) == htmltext.OUT


def test_html_takes_linear_time():
    for p in ('<a "', "<a ", '<p x=">" ', '<div class="a<b">', "<a '\"", "<script ", "<select>", "<nav>", "<svg>", "<!--", "<p title='"):
        began = time.process_time()
        assert isinstance(htmltext.extract(p * 20_000, {}), str)
        assert time.process_time() - began < 5


def test_html_on_pages_it_was_not_fitted_on(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    weights = htmltext.fit_weights(pages[:10])
    for p in pages[10:]:
        inner = p.split("<article>")[1].split("</article>")[0]
        bare = htmltext.entities.unescape(htmltext.re.sub(r"<[^>]*>", " ", htmltext.re.sub(r"</?(?:b|a)(?: [^>]*)?>", "", inner)))
        assert htmltext.extract(p, weights) == " ".join(bare.split())


ODD = ["a@b.c_d@e.f x@y", "a.b+c@d-e.fg.h.", "1.2.3.4.5 300.1.1.1 001.002.003.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485 +123", "+49.30.1234567890123456", "é 4111111111111111 ü 1.1.1.1", "12 34 56 78 90 12 34 " * 300, "@" * 50, "+1" * 40, "a" * 5000 + "@b.co"]


def test_personal_data(docs, rows, none, spark):
    table = [*rows, *((1000 + i, t) for i, t in enumerate(ODD))]
    got = pii.find(frame(spark, table)).collect()
    assert key((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == key((d, *brute.personal(t)) for d, t in table)
    assert pii.find(none).count() == 0


def test_secrets_are_added_and_base_spans_stay(spark):
    rng = random.Random(9)
    rows, secrets = [], 0
    for i in range(300):
        text = prose(rng, 30)
        if i % 3 == 0:
            text += f' token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}" more'
            secrets += 1
        elif i % 3 == 1:
            text += f" call item-{rng.randrange(10)}-of-the-list2 or mail a{i}@b.com now"
        rows.append((i, text))
    got = {r.doc_id: r for r in pii.find(frame(spark, rows)).collect()}
    assert sum(r.n_added for i, r in got.items() if i % 3 == 0) == secrets
    assert sum(r.n_added for i, r in got.items() if i % 3) == 0
    assert all(r.n_email == 1 for i, r in got.items() if i % 3 == 1)
    red = {r.doc_id: r.text for r in pii.redact(frame(spark, rows)).collect()}
    assert all("[SECRET]" in red[i] for i in range(0, 300, 3)) and all("[EMAIL]" in red[i] and "@" not in red[i] for i in range(1, 300, 3))
    assert all(red[i] == rows[i][1] for i in range(2, 300, 3))


def test_long_texts_with_very_many_spans(spark):
    rng = random.Random(31)
    kinds = ["number {0} and so on", "mail a{0}.b@c-d.org now", "at 10.2.{1}.7 é", "card 4111 1111 1111 1111, or 4111111111111112", "+1 (988) 555-2485", 'token = "{2:040x}"', "üöä 日本 😀", "x{0:015d}@mail.de"]
    text = lambda n: " ".join(rng.choice(kinds).format(i, i % 300, rng.getrandbits(160)) for i in range(n))
    rows = [(i, text(n)) for i, n in enumerate([1, 5, 64, 65, 300, 4097, 40_000])]
    docs = frame(spark, rows)
    model = pii.train(docs.select("doc_id", F.col("text").alias("_text")), "_text")
    got = {r.doc_id: r for r in pii.find(docs, model=model).collect()}
    red = {r.doc_id: r.text for r in pii.redact(docs, model=model).collect()}
    for i, t in rows:
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone, got[i].base_sha256) == brute.personal(t)
        out, at = [], 0
        for kind, a, b in (x.split(":") for x in got[i].spans.split(",") if x):
            if int(a) >= at:
                out += [t[at : int(a)], f"[{kind.upper()}]"]
            at = max(at, int(b))
        assert red[i] == "".join(out) + t[at:]


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 4096, 4097, 300_000])
def test_running_sums_and_maxima(spark, size):
    values = [(i * 7919) % 101 for i in range(size)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    sums, tops = df.selectExpr(pii.running("v", "{a} + {b}"), pii.running("v", "greatest({a}, {b})")).first()
    want = np.concatenate([[0], np.cumsum(values)])[:-1].tolist() if values else []
    assert sums == want and tops == (np.concatenate([[0], np.maximum.accumulate(values)])[:-1].tolist() if values else [])


def test_expectation_maximisation_finds_the_unreliable_labeler():
    rng = random.Random(5)
    counts = {}
    for _ in range(6000):
        truth = rng.random() < 0.3
        votes = tuple(int(truth) if rng.random() < q else int(not truth) for q in (0.95, 0.9, 0.55))
        counts[votes] = counts.get(votes, 0) + 1
    post, rates = pii.estimate([(v, (), n) for v, n in counts.items()])
    assert rates[0][0] > 0.85 and rates[2][0] < 0.7
    assert post[(1, 1, 0)] > 0.9 > 0.1 > post[(0, 0, 1)]
    assert pii.estimate([]) == ({}, [])


def test_crc_of_no_ids():
    assert zlib.crc32(b"") == brute.crc([])


def test_bands_come_from_all_labelled_documents(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 7)))
    vocab = [word() for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(40))[: rng.randint(128, 159)]) for i in range(30_000)]
    docs = frame(spark, rows).repartition(4)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows], "doc_id long, quality int, toxic int").repartition(2)
    bands, chunk = quality.fit_bands(docs, labels)
    report = quality.quality_report(docs, labels).collect()
    ratios = sorted(r.ratio for r in report if not r.base_failed)
    at = lambda q: ratios[math.ceil(q * len(ratios)) - 1]
    assert bands[0] == (128, max(0.35, 0.98 * at(0.002)), min(1.0, 1.02 * at(0.998))) and bands[0] != quality.BANDS[0]
    assert all(r.kept == (not r.base_failed and quality.verdict(r.n_bytes, r.ratio, r.min_chunk, r.max_chunk, bands, chunk)) for r in report)


def test_tasks_of_near_duplicates_follow_the_rows_and_not_the_shuffle_partitions(spark):
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join([*words, f"x{i}"])) for i in range(140)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sc = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("near-dup-tasks", "")
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame).collect()}
        stages = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup("near-dup-tasks") for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(140)}
    # a stage that only counts, joins or writes does not take the 97 tasks
    assert sum(s.numCompletedTasks >= 97 for s in stages if s) <= 20

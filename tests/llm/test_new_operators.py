"""Conversation repair, filter audit and SimHash against plain forms."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from storyloom.llm import convrepair, filteraudit, simhash
from storyloom.llm.queries import queries
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string, part int, kind string, letter string, seq long"


def key(rows):
    return sorted(tuple(map(repr, r)) for r in rows)


def tuples(df, *cols):
    return key(df.select(*cols).collect())


# conversations

REPORT = ("conv_id", *convrepair.COUNTS, "audit", "repaired_sha256")


def talks(seed, n=120, longest=12):
    rng, out = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "so", "and then", "", " \n", None, "a.b", "x" * 50 + ".", "é à."]
    for c in [*range(n), None]:
        turns = rng.sample(range(30), rng.randint(0, longest)) + rng.choice([[], [None]])
        for t in turns:
            out.append((c, t, rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None, ""]), rng.choice(texts)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "l", 7) for r in rows], CONV).repartition(3)


@pytest.mark.parametrize(("held", "partitions"), [(convrepair.HELD, 3), (100, 5), (0, 2), (convrepair.HELD, 40)])
def test_conversations_in_ranges_and_by_parts(spark, held, partitions):
    rows = talks(3)
    got = convrepair.repair(convrepair.damaged(frame(spark, rows)), held=held, partitions=partitions)
    assert tuples(got, *REPORT) == key(brute.conversations(rows))


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "so", ""]) + f"{t // 3}" * rng.randint(0, 1) + rng.choice(".x")) for t in range(400)]
    rows += [(8, None, "user", "same.")] * 300 + [(9, 1, "system", "only.")]
    got = convrepair.repair(convrepair.damaged(frame(spark, rows)), partitions=24)
    assert tuples(got, *REPORT) == key(brute.conversations(rows))


def test_parts_that_meet_in_every_state(spark):
    rows = [(c, t, r, f"{t}.") for c, roles in enumerate(["su" + "au" * 20, "ss" * 20, "a" * 41, "uua" * 14, "tu" * 20]) for t, r in enumerate({"s": "system", "u": "user", "a": "assistant", "t": "tool"}[x] for x in roles)]
    got = convrepair.repair(frame(spark, rows), held=1, partitions=12)
    assert got.count() == 5
    for r in got.collect():
        mine = [(x[2][0] if x[2][0] in "sua" else "o", False, False) for x in rows if x[0] == r.conv_id]
        assert (r.cost, r.audit) == brute.cheapest_edits(mine)


def test_conversations_without_rows(spark):
    assert convrepair.repair(frame(spark, []), partitions=2).count() == 0
    gone = frame(spark, [(1, 1, "user", "a.")]).withColumn("copies", F.lit(0))
    for held in (0, convrepair.HELD):
        [r] = convrepair.repair(gone, held=held, partitions=2).collect()
        assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "", "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")


def test_edits_against_costs_in_order():
    rng = random.Random(1)
    for _ in range(4000):
        letters = "".join(rng.choice(convrepair.LETTERS) for _ in range(rng.randint(0, 9)))
        cost, audit = brute.cheapest_edits([(x.lower(), x == "x", x.isupper()) for x in letters])
        assert convrepair.cheapest(letters) == (audit, cost)


def test_a_long_conversation_takes_linear_time():
    letters = "uAasx" * 20_000
    dist = convrepair.distances(letters)
    audit, states = convrepair.walk(letters, dist)
    assert len(states) == len(audit) + 1 and states[-1] in (convrepair.START, convrepair.ASSISTANT)


def test_conversations_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert tuples(queries()["op11_conversation_repair"](spark, DATA), *REPORT) == key(brute.conversations(rows))


# filters

DOCS = "doc_id long, text string, lang string, part string, mask int, digest string, n long, good int"


def marked(seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(140):
        words = [rng.choice(["alpha", "beta", "Gamma", "d$", "EPSILON", f"w{rng.randint(0, 300)}"][: rng.randint(1, 6)]) for _ in range(rng.choice([0, 3, 150, 199, 200, 260]))]
        out.append((i, rng.choice([" ", "\n", "  "]).join(words), rng.choice(["en", "de", None, ""])))
    out += [(1000 + i, rng.choice(out[:20])[1], "fr") for i in range(40)] + [(None, out[3][1], "en"), (None, None, None), (5, None, "en"), (6, "", "de"), (6, "", "de"), (3, out[3][1], "xx"), (-4, out[4][1], "en"), (2000, "w " * 200_000, "en"), (2001, "É" * 100 + "ABC", "en")]
    return out


def test_filters_against_walking_each_document(spark):
    docs, labels = marked(), [(i, i % 3 == 0, i % 5 == 0) for i in range(0, 1100, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (7, None, None)]
    labels = [(d, None if q is None else int(q), None if t is None else int(t)) for d, q, t in labels]
    df = spark.createDataFrame([(*r, "p", 1, "d", 2, 3) for r in docs], DOCS).repartition(3)
    known = spark.createDataFrame([(*r, "en") for r in labels], "doc_id long, quality int, toxic int, lang string")
    got = filteraudit.audit(df, known)
    assert tuples(got, "part", "filter_order", "step", *filteraudit.COUNTS) == key(brute.filter_audit(docs, labels))


def test_filters_of_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(docs, labels).count() == 0
    one = filteraudit.audit(spark.createDataFrame([(1, None, None, "p", 1, "d", 2, 3)], DOCS), labels)
    assert one.count() == 600 and one.where("part = ''").agg(F.sum("removed")).first()[0] == 120


def test_interactions_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0b011, 4, 1, 0), ("p", 0b100, 2, 0, 1), ("p", 0, 10, 5, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): r for r in filteraudit.interactions(cells, "XYZ").collect()}
    assert len(got) == 18
    assert (got["XYZ", 1].removed, got["XYZ", 2].removed, got["XYZ", 2].redundant, got["XYZ", 3].removed) == (4, 0, 4, 2)
    assert got["XYZ", 3].kept == 10 and got["XYZ", 1].shapley == 12 and got["XYZ", 3].shapley == 12 and got["XYZ", 3].unique_fails == 2


# simhash

TEXTS = "doc_id long, text string, print long, prefix long, comp long, fingerprint string"


def test_prints_against_plain_counts():
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "One  TWO\tthree", "a b c d", "É é ü ß " * 9, "a " * 3000, "x\x1fy z w v", *(" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 700))) for _ in range(60))]
    assert [simhash.fingerprint(t) for t in texts] == [brute.simhash(t) for t in texts]


def test_a_text_over_several_blocks():
    text = " ".join(f"w{i * i % 977}" for i in range(70_000))
    assert simhash.fingerprint(text) == brute.simhash(text)


def near_prints(seed, n=60, copies=12):
    rng, out = random.Random(seed), [0, 1, 31, (1 << 64) - 1]
    for _ in range(n):
        p = rng.getrandbits(64)
        out.append(p)
        for _ in range(copies):
            q = p
            for _ in range(rng.randint(1, 7)):
                q ^= 1 << rng.randrange(64)
            out.append(q)
    return sorted(set(out))


@pytest.mark.parametrize(("distance", "mean", "most"), [(4, 256, 1 << 21), (4, 4, 3000), (4, 1, 1), (2, 8, 60), (0, 8, 60), (6, 300, 1 << 21)])
def test_links_join_what_all_pairs_join(spark, distance, mean, most):
    from storyloom.llm.components import connected_components

    prints = near_prints(distance, *((12, 6) if distance == 6 else (60, 12)))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long").repartition(3), distance, mean, most)
    pairs = found.collect()
    unsigned = lambda x: x & (1 << 64) - 1
    of = brute.joined(prints, distance)
    where = dict(zip(prints, of, strict=True))
    assert all(where[unsigned(r.a)] == where[unsigned(r.b)] for r in pairs)
    got = {unsigned(r.node): unsigned(r.component) for r in connected_components(found).collect()}
    groups = lambda f: {frozenset(p for p in prints if f(p) == c) for c in map(f, prints)}
    assert groups(lambda p: got.get(p, p)) == groups(where.get)


def test_documents_by_prints(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate([*base, *base[:9], *(f"{t} more" for t in base[:30]), None, "", " ", "One two", "one  TWO"])]
    df = spark.createDataFrame([(*r, 1, 2, 3, "f") for r in rows], TEXTS).repartition(3)
    assert tuples(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == key(brute.simhash_groups(rows))
    assert simhash.near_duplicates(spark.createDataFrame([], TEXTS)).count() == 0


def test_null_and_repeated_ids(spark):
    far = ["alpha beta gamma delta epsilon", "one two three four five six"]
    rows = [(None, far[0]), (3, far[0]), (3, far[0]), (2, far[1]), (3, far[1]), (9, far[0])]
    got = simhash.near_duplicates(spark.createDataFrame([(*r, 1, 2, 3, "f") for r in rows], TEXTS))
    assert sorted((r.doc_id or -1, r.component_id) for r in got.collect()) == [(-1, None), (2, 2), (3, 2), (3, 2), (3, 2), (9, 2)]


def test_documents_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op13_simhash_dedup"](spark, DATA)
    assert tuples(got, "doc_id", "fingerprint", "component_id") == key(brute.simhash_groups(rows))

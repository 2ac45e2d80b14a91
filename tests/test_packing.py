"""Chunks and segments by pointers against plain folds line by line."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from storyloom.operators import chunking


def plain_chunks(lengths, size):
    out, cur, chunk = [], 0, 0
    for n in lengths:
        if cur + n + 1 > size and cur > 0:
            chunk, cur = chunk + 1, 0
        cur += n + 1
        out.append(chunk)
    return out


def plain_loose(lengths, size):
    if sum(lengths) + len(lengths) - 1 <= size:
        return [0] * len(lengths)
    out, cur, held, chunk = [], 0, 0, 0
    for n in lengths:
        if cur + n > size and held:
            chunk, cur, held = chunk + 1, n, 1
        else:
            cur, held = cur + n + 1, held + 1
        out.append(chunk)
    return out


def plain_segments(lines, low, high, target):
    buf, out = "", []
    for line in lines:
        both = buf + line
        if len(both) > high:
            if len(buf) >= low:
                out.append(buf)
                buf = line
            else:
                out.append(both)
                buf = ""
        elif len(both) >= target(len(out)):
            out.append(both)
            buf = ""
        else:
            buf = both
    return [x for x in (*(s.strip() for s in out), buf.strip()) if x]


def test_chunk_numbers():
    rng = random.Random(1)
    for _ in range(2000):
        lengths = [rng.choice([0, 0, 1, 5, 9, 10, 11, 40]) for _ in range(rng.randint(0, 30))]
        size = rng.choice([0, 1, 10, 11, 12, 25, 60])
        assert chunking.chunk_numbers(lengths, size).tolist() == plain_chunks(lengths, size)
        assert chunking.chunk_numbers(lengths, size, loose=True).tolist() == plain_loose(lengths, size)


def test_segment_bounds():
    rng = random.Random(2)
    for _ in range(3000):
        lines = ["x" * rng.choice([0, 1, 5, 9, 30, 60]) + "\n" for _ in range(rng.randint(0, 25))] + ["y" * rng.randint(1, 9)]
        low = rng.choice([0, 1, 10, 20, 40])
        high = low + rng.choice([0, 5, 30])
        aims = [rng.randint(low, high) for _ in range(100)]
        got = ["".join(lines[s:e]).strip() for s, e in chunking.segment_bounds([len(x) for x in lines], low, high, aims)]
        assert [x for x in got if x] == plain_segments(lines, low, high, aims.__getitem__)


def test_a_text_of_a_million_lines_takes_seconds(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 80, 1_000_000)
    began = time.perf_counter()
    n = chunking.chunk_numbers(lengths, 60)[-1]
    assert len(chunking.segment_bounds(lengths + 1, 40, 60, [50] * 2_000_000)) > 100_000 and n > 100_000
    assert time.perf_counter() - began < 15
    text = "\n".join("x" * int(k) for k in lengths[:200_000])
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    began = time.perf_counter()
    assert df.select(F.size(chunking.split_segments("text", 2000, 4000, "doc"))).first()[0] > 1500
    assert df.select(F.array_max(chunking.line_chunks(F.split("text", "\n"), 500))).first()[0] > 15_000
    assert time.perf_counter() - began < 60


def test_segments_of_the_tables_row_by_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    aims = F.transform(F.sequence(F.lit(0), F.lit(200)), lambda n: F.lit(300) + F.pmod(F.xxhash64(F.lit(7), F.col("doc_id").cast("string"), n), F.lit(301)).cast("int"))
    for r in docs.select("text", chunking.split_segments("text", 300, 600, "doc_id", 7).alias("got"), aims.alias("aims")).collect():
        lines = [x for x in r.text.replace("\n", "\n\0").split("\0") if x]
        assert r.got == plain_segments(lines, 300, 600, r.aims.__getitem__)

"""Operator 5: quality rules by compression bands.

Whole documents and their fixed chunks (the last one ends with the text and may overlap) are compressed with zstandard; compressed over raw size below a band's lower
limit means repetitive text, above its upper limit incompressible text. Bands are by length, because a short text cannot
compress well. Default limits are wide, the upper ones just under what random letters, digits and spaces reach from 192 bytes on; ``fit_bands``
narrows both to just outside what labelled good documents show: all of them, by a table of every document's measures, which meets the labels without its texts.

Defined results: null text has no words and fails the base rule; repeated rows are judged each; other columns are
ignored by ``quality_report`` and kept by ``quality_filter``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.llm.runtime import small_batches, source, write_table
from storyloom.llm.vectext import SPACE, U, Words, chunks, mix, record

CHUNK = 4096
LEVEL = 3
#: (from so many bytes on, lower limit, upper limit); texts under 128 bytes are not judged by ratio
BANDS = ((128, 0.35, 1.0), (160, 0.35, 0.95), (192, 0.35, 0.90), (224, 0.35, 0.86), (256, 0.32, 0.85), (320, 0.32, 0.83), (384, 0.32, 0.79), (512, 0.30, 0.77), (768, 0.30, 0.75), (1024, 0.28, 0.73), (2048, 0.26, 0.70), (4096, 0.24, 0.68), (8192, 0.22, 0.66), (16384, 0.18, 0.66), (65536, 0.15, 0.65))
CHUNK_BAND = (0.24, 0.70)

DDL = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_bytes long, ratio double, min_chunk double, max_chunk double"
_OUT = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_bytes", pa.int64()), *((k, pa.float64()) for k in ("ratio", "min_chunk", "max_chunk"))])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = b" \t\n\r\x0b\x0c"


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off])


def repeat_words(w: Words, n: int = 5) -> np.ndarray:
    """Words of each row inside n-word windows that its text holds twice or more."""
    at, h = w.grams(n)
    if not len(at):
        return np.zeros(len(w.count), np.int64)
    key = mix(h + w.doc[at].astype(U) * U(0x9E3779B97F4A7C15))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = at[count[back] > 1]
    step = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + n, -1)
    return np.bincount(w.doc[np.cumsum(step[:-1]) > 0], minlength=len(w.count)).astype(np.int64)


def verdict(n_bytes: int, ratio: float | None, low: float | None, high: float | None, bands: tuple = BANDS, chunk_band: tuple = CHUNK_BAND) -> bool:
    """Whether a text's ratios lie inside the limits for its length."""
    i = bisect_right([b[0] for b in bands], n_bytes)
    if i and not bands[i - 1][1] <= ratio <= bands[i - 1][2]:
        return False
    return low is None or (chunk_band[0] <= low and high <= chunk_band[1])


def chunk_starts(n_bytes: int) -> list[int]:
    """Where a text's chunks start: one after the other, and the last ``CHUNK`` bytes, so that every byte of a text of a chunk or more is judged."""
    starts = list(range(0, n_bytes - CHUNK + 1, CHUNK))
    return [*starts, n_bytes - CHUNK] if starts and n_bytes % CHUNK else starts


def measure_batch(column: pa.Array, bands: tuple, chunk_band: tuple) -> dict[str, object]:
    z = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    w = Words(column)
    buf, off = w.buf, w.offsets
    raw = buf.tobytes()
    dup, whole, low, high, fine = [], [], [], [], []
    n, rep = w.count.astype(np.int64), repeat_words(w)
    failed = (n < 10) | (100 * rep > 20 * n)
    for s, e, bad in zip(off[:-1], off[1:], failed, strict=True):
        text = raw[s:e]
        lines = [x for x in text.split(b"\n") if x.strip(_BLANK)]
        dup.append(len(lines) - len(set(lines)))
        ratio = len(z.compress(text)) / len(text) if text else None
        parts = [len(z.compress(text[i : i + CHUNK])) / CHUNK for i in chunk_starts(len(text))]
        whole.append(ratio)
        low.append(min(parts, default=None))
        high.append(max(parts, default=None))
        fine.append(not bad and verdict(len(text), ratio, low[-1], high[-1], bands, chunk_band))
    solid = ((buf & 0xC0) != 0x80) & ~SPACE[buf]
    return {"n_words": n, "word_chars": _per_row(solid, off), "n_symbols": _per_row(_SYMBOL[buf], off), "n_dup_lines": dup, "n_repeat_words": rep, "base_failed": failed, "kept": fine, "n_bytes": np.diff(off), "ratio": whole, "min_chunk": low, "max_chunk": high}


def within(bands: tuple, chunk_band: tuple) -> Column:
    """``verdict`` over measures, behind the base rule."""
    band = F.lit(True)
    for least, low, high in bands:
        band = F.when(F.col("n_bytes") >= least, F.col("ratio").between(low, high)).otherwise(band)
    chunk = F.col("min_chunk").isNull() | ((F.col("min_chunk") >= chunk_band[0]) & (F.col("max_chunk") <= chunk_band[1]))
    return ~F.col("base_failed") & band & chunk


def quality_report(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", limits: tuple[tuple, tuple] | None = None) -> DataFrame:
    """Measures, base_failed and kept for each row. With labels the measures are taken once, as a table, for the fit and the verdict."""
    if limits is None and labels is not None:
        measures = write_table(quality_report(docs, None, id_col, text_col), "measures")
        return measures.withColumn("kept", within(*_fit(measures, labels)))
    limits = limits or (BANDS, CHUNK_BAND)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            yield record(_OUT, doc_id=b.column("doc_id"), **measure_batch(b.column("text"), *limits))

    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    return src.mapInArrow(emit, DDL)


def quality_filter(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", limits: tuple[tuple, tuple] | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; they are judged where they are read, without a shuffle."""
    limits = limits or (fit_bands(docs, labels, id_col, text_col) if labels is not None else (BANDS, CHUNK_BAND))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, text_col):
            yield b.filter(pa.array(measure_batch(b.column(text_col), *limits)["kept"], pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(emit, docs.schema)


def fit_bands(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> tuple[tuple, tuple]:
    """Bands and chunk band whose limits lie 2 % outside the 0.2 % and 99.8 % quantiles of good documents, where ``least`` of them
    are in a band; lower limits come from neighbouring bands of one default lower limit together."""
    return _fit(write_table(quality_report(docs, None, id_col, text_col).select("doc_id", "base_failed", "n_bytes", "ratio", "min_chunk", "max_chunk"), "measures"), labels, least)


def _fit(measures: DataFrame, labels: DataFrame, least: int = 50) -> tuple[tuple, tuple]:
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("good_id"))
    m = measures.join(good, F.col("doc_id") == F.col("good_id"), "left_semi").where("not base_failed")
    group = lambda first: F.expr("case " + " ".join(f"when n_bytes >= {b[0]} then {first(i)}" for i, b in reversed([*enumerate(BANDS)])) + " else -1 end")
    wide = [next(j for j, b in enumerate(BANDS) if b[1] == lo) for _, lo, _ in BANDS]
    ends = [F.percentile_approx(c, q, 100_000).alias(k) for c, q, k in (("ratio", 0.002, "low"), ("ratio", 0.998, "high"), ("min_chunk", 0.002, "chunk_low"), ("max_chunk", 0.998, "chunk_high"))]
    got = m.rollup(group(lambda i: wide[i]).alias("wide"), group(lambda i: i).alias("band")).agg(F.count("*").alias("n"), F.count("min_chunk").alias("c"), *ends).where("wide is not null").collect()
    low = {r["wide"]: 0.98 * r["low"] for r in got if r["band"] is None and r["n"] >= least and r["low"] is not None}
    high = {r["band"]: 1.02 * r["high"] for r in got if r["band"] is not None and r["n"] >= least and r["high"] is not None}
    chunk_low = min((0.98 * r["chunk_low"] for r in got if r["band"] is not None and r["c"] >= least), default=CHUNK_BAND[0])
    chunk_high = max((1.02 * r["chunk_high"] for r in got if r["band"] is not None and r["c"] >= least), default=CHUNK_BAND[1])
    bands = tuple((e, max(lo, low.get(wide[i], lo)), min(hi, high.get(i, hi))) for i, (e, lo, hi) in enumerate(BANDS))
    return bands, (max(CHUNK_BAND[0], chunk_low), min(CHUNK_BAND[1], chunk_high))

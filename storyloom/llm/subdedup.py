"""Operator 1: substring dedup by seed and extend on winnowed anchors.

Every window of ``min_words`` words has one seed: the smallest hash among its ``seed_words``-grams (winnowing).
Equal windows have equal seeds, so only places whose seed occurs again anywhere are extended. A *run* is a stretch
of neighbouring windows with one anchor (the leftmost place of the seed); its context is the word span they cover. Runs with equal seed and context
match in full. Where one seed has several contexts, one run of each context is extended left and right word by
word against the others, as hashes of its windows, and the matching windows make up the maximal repeats.

No pairs are formed: copies meet in counts that are combined before the shuffle, and joins on seed, context and
window hash are plain sort-merge joins, which Spark splits when one key is hot.

Defined results: null or empty text has no words and loses none; a text shorter than the window loses none; a
repeated row counts as another place, so both lose their windows; a null id is an id like any other; other
columns, whatever their names, are ignored by the query and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.runtime import small_batches, write_table
from storyloom.llm.vectext import GRAM, GRAM2, Words, chunks, mix, record, sliding_argmin

_RUNS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.binary()), ("s0", pa.int32()), ("n", pa.int32()), ("times", pa.int32()), ("seed", pa.int64()), ("ctx", pa.int64())])
_WINDOWS = pa.schema([("doc_id", pa.int64()), ("tkey", pa.binary()), ("s0", pa.int32()), ("sure", pa.bool_()), ("x1", pa.int64()), ("x2", pa.int64())])


def runs_of(words: Words, min_words: int, seed_words: int) -> dict[str, np.ndarray]:
    """The runs of a batch: row, first window (word offset in its row), number of windows, times it comes in a row, seed and context hash."""
    m = len(words.hash) - min_words + 1
    none = {k: np.zeros(0, np.int64) for k in ("doc", "s0", "n", "times", "seed", "ctx")}
    if m <= 0:
        return none
    at = np.flatnonzero(words.doc[:m] == words.doc[min_words - 1 :])
    if not len(at):
        return none
    width = min_words - seed_words + 1
    pre = GRAM.prefix(words.hash)
    grams = np.arange(len(words.hash) - seed_words + 1)
    hashes = GRAM.slices(pre, grams, grams + seed_words)
    anchor = sliding_argmin(hashes, width)[at]
    seed = hashes[anchor]
    breaks = np.ones(len(at), bool)
    breaks[1:] = anchor[1:] != anchor[:-1]
    head = np.flatnonzero(breaks)
    n = np.diff(np.append(head, len(at)))
    s = at[head]
    ctx = mix(GRAM2.slices(GRAM2.prefix(words.hash), s, s + n + min_words - 1))
    # periodic text: neighbouring runs with one context count as one row
    lead = np.ones(len(s), bool)
    lead[1:] = (s[1:] != s[:-1] + n[:-1]) | (ctx[1:] != ctx[:-1]) | (n[1:] != n[:-1]) | (seed[head][1:] != seed[head][:-1])
    at = np.flatnonzero(lead)
    times = np.diff(np.append(at, len(s)))
    s = s[at]
    return {"doc": words.doc[s], "s0": s - words.first[words.doc[s]], "n": n[at], "times": times, "seed": seed[head][at], "ctx": ctx[at]}


def _emit_runs(min_words: int, seed_words: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            r = runs_of(Words(b.column("text")), min_words, seed_words)
            rows = pa.array(r["doc"])
            yield record(_RUNS, doc_id=b.column("doc_id").take(rows), tkey=b.column("tkey").take(rows), s0=r["s0"].astype(np.int32), n=r["n"].astype(np.int32), times=r["times"].astype(np.int32), seed=r["seed"].astype(np.uint64).view(np.int64), ctx=r["ctx"].astype(np.uint64).view(np.int64))

    return emit


def _emit_windows(min_words: int):
    """Windows of the listed runs of each row, as two independent 64-bit hashes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            w = Words(b.column("text"))
            p1, p2 = GRAM.prefix(w.hash), GRAM2.prefix(w.hash)
            runs = b.column("runs")
            who = np.repeat(np.arange(b.num_rows), runs.value_lengths().to_numpy(zero_copy_only=False))
            items = runs.flatten()
            s0, n, sure = (np.asarray(items.field(k)) for k in ("s0", "n", "sure"))
            each = np.repeat(np.arange(len(s0)), n)
            off = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            local = s0[each] + off
            at = w.first[who[each]] + local
            rows = pa.array(who[each])
            yield record(_WINDOWS, doc_id=b.column("doc_id").take(rows), tkey=b.column("tkey").take(rows), s0=local.astype(np.int32), sure=np.asarray(sure)[each].astype(bool), x1=GRAM.slices(p1, at, at + min_words).view(np.int64), x2=GRAM2.slices(p2, at, at + min_words).view(np.int64))

    return emit


def covered(n_words: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of n words the half-open spans cover."""
    step = np.zeros(n_words + 1, np.int64)
    for s, e in spans:
        step[s] += 1
        step[e] -= 1
    return np.cumsum(step[:-1]) > 0


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("tkey"), text.alias("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 35, seed_words: int = 6) -> DataFrame:
    """(doc_id, tkey, text, spans): each row with the word spans [from, to) of its windows that start elsewhere too.

    ``tkey`` tells rows with one id but different texts apart.
    """
    if not 0 < seed_words <= min_words:
        raise ValueError("seed_words must be from 1 to min_words")
    keyed = _keyed(docs, id_col, text_col)
    ddl = "doc_id long, tkey binary, s0 int, n int, times int, seed long, ctx long"
    runs = write_table(keyed.where("text is not null").mapInArrow(_emit_runs(min_words, seed_words), ddl), "runs")
    # tables, so that both sides of the joins are plain shuffles, which Spark splits where a key is hot
    again = write_table(runs.groupBy("seed").agg(F.sum("times").alias("places")).where("places > 1").select("seed"), "again")
    cand = write_table(runs.join(again, "seed"), "seeded")
    classes = write_table(cand.groupBy("seed", "ctx").agg(F.sum("times").alias("copies"), F.min(F.struct("doc_id", "tkey", "s0", "n")).alias("one")), "classes")
    many = write_table(classes.groupBy("seed").agg(F.count("*").alias("kinds")).where("kinds > 1").select("seed"), "many")
    sure = cand.join(classes.where("copies > 1").select("seed", "ctx"), ["seed", "ctx"])
    spans = sure.select("doc_id", "tkey", F.col("s0").alias("a"), (F.col("s0") + F.col("n") * F.col("times") + (min_words - 1)).alias("b"))
    extend = classes.join(many, "seed").select("one.*", (F.col("copies") > 1).alias("sure")).groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("s0", "n", "sure")).alias("runs"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["tkey"].eqNullSafe(b["tkey"])
    # the same unfiltered texts as in the last join, so that one exchange of them serves all
    windows = keyed.join(extend, same(keyed, extend)).select(keyed["doc_id"], keyed["tkey"], "text", "runs").mapInArrow(_emit_windows(min_words), "doc_id long, tkey binary, s0 int, sure boolean, x1 long, x2 long")
    # a window of a run whose context is unique comes once; those of repeated rows come with ``sure``
    hits = windows.groupBy("x1", "x2").agg(F.count("*").alias("places"), F.max("sure").alias("sure")).where("places > 1 or sure").select("x1", "x2")
    more = windows.where("not sure").join(hits, ["x1", "x2"]).select("doc_id", "tkey", F.col("s0").alias("a"), (F.col("s0") + min_words).alias("b"))
    per_doc = spans.unionByName(more).groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return keyed.join(per_doc, same(keyed, per_doc), "left").select(keyed["doc_id"], keyed["tkey"], "text", "spans")


def _apply(with_text: bool):
    out = pa.schema([("doc_id", pa.int64()), ("tkey", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + [("kept_text", pa.string())] * with_text)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts, lists = b.column("text"), b.column("spans")
            rows: list[tuple] = []
            for i in range(b.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                spans = [(x["a"], x["b"]) for x in lists[i].as_py() or ()]
                cut = covered(len(words), spans) if spans else ()
                kept = b" ".join([w for w, gone in zip(words, cut, strict=True) if not gone]) if spans else b" ".join(words)
                rows.append((len(words), int(np.sum(cut)), hashlib.sha256(kept).hexdigest(), kept.decode()))
            n, gone, sha, kept_text = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield record(out, doc_id=b.column("doc_id"), tkey=b.column("tkey"), n_words=list(n), n_removed=list(gone), kept_sha256=list(sha), kept_text=list(kept_text))

    return emit


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 35, seed_words: int = 6, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for each row of ``docs``."""
    spans = repeated_spans(docs, id_col, text_col, min_words, seed_words)
    ddl = "doc_id long, tkey binary, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return spans.mapInArrow(_apply(with_text), ddl).drop("tkey")

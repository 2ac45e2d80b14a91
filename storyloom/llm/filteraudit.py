"""Operator 12: how filters interact, for every order in which they may run.

Each document has a mask, one bit a filter that it fails. Documents are counted by part and mask before anything else, so that a part
(a third of all rows, say) goes on as at most 2**filters cells. The cells are unpivoted against the steps of all orders, a running
bit-or over a cell's steps tells what an earlier filter has removed, conditional sums give each step's counts, and a
window over a part's rows of one filter gives its total over all orders.

A document's text decides four filters where it is read (one pass, vectorised); the fifth, an identical text under a smaller id,
needs no join: rows are counted by digest and id, then by digest and part with the count at the smallest id, so a text that a third of
all rows share is combined before it is moved.

Defined results: a null text is empty, a null part the empty string; a row with a null id is never a copy of a smaller id, makes none
and has no labels; repeated rows count each, and none fails as a copy of the other; labels count if any row of an id has them; an empty table
gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.runtime import source
from storyloom.llm.vectext import Words, chunks, record

#: the filters on a text, in the order of their bits, and the one on copies
FILTERS = "ABCDE"
SHORT, DISTINCT, CAPITALS = 200, 50, 3
MARKS = np.zeros(256, bool)
MARKS[list(b"#$%&*|")] = True
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_MASKS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def text_masks(column: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    w = Words(column)
    order = np.lexsort((w.hash, w.doc))
    doc, h = w.doc[order], w.hash[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    distinct = np.bincount(doc[new], minlength=len(w.count))
    capitals = _per_row((w.buf >= 65) & (w.buf <= 90), w.offsets)
    points = _per_row((w.buf & 0xC0) != 0x80, w.offsets)
    failed = (w.count < SHORT, 100 * distinct < DISTINCT * w.count, 100 * capitals > CAPITALS * points, _per_row(MARKS[w.buf], w.offsets) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        digest = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in b.column("text").to_pylist()]
        yield record(_MASKS, doc_id=b.column("doc_id"), part=b.column("part"), digest=pa.array(digest, pa.binary()), mask=text_masks(b.column("text")))


def mask_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled good and toxic, of each part that fail just the filters of the mask."""
    src = source(docs, doc_id=(id_col, "long"), part=(part_col, "string"), text=(text_col, "string"))
    marked = src.withColumn("part", F.coalesce("part", F.lit(""))).mapInArrow(_masks, "doc_id long, part string, digest binary, mask int")
    has = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l_id")).agg(has("quality").alias("good"), has("toxic").alias("toxic"))
    kind = ["part", "mask", "good", "toxic"]
    rows = marked.join(known, F.col("doc_id") == F.col("l_id"), "left").select("doc_id", "digest", "part", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    by_id = rows.groupBy("digest", "doc_id", *kind).agg(F.count("*").alias("n"))
    # a group's rows at its smallest id are the only ones that may be first of their text
    own = by_id.groupBy("digest", *kind).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"))
    first = F.min("least").over(Window.partitionBy("digest"))
    own = own.withColumn("firsts", F.col("unnamed") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0))
    split = F.array(F.struct(F.col("mask"), F.col("firsts").alias("n")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))
    cells = own.select("part", "good", "toxic", F.explode(split).alias("c")).select("part", "good", "toxic", "c.*").where("n > 0")
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def interactions(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, ``COUNTS``) of ``cells`` (part, mask, n, good, toxic), a bit of the mask for each letter of ``names``.

    Every step of every order has its row in each part that has a cell, with zeros where nothing falls to it. All orders of the filters are
    walked, so their number is for few filters (720 orders of six); the rows follow parts, never documents.
    """
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in itertools.permutations(names)]))
    long = cells.select("part", "mask", "n", "good", "toxic", orders.alias("filter_order"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.expr(f"shiftleft(1, locate(substr(filter_order, {i}, 1), '{names}') - 1)").alias("bit")) for i in range(1, len(names) + 1)]))
    long = long.select("*", steps.alias("s")).select("part", "mask", "n", "good", "toxic", "filter_order", "s.*")
    before = Window.partitionBy("part", "mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    fails, gone = F.expr("mask & bit <> 0"), F.expr("mask & earlier <> 0")
    marked = long.withColumn("earlier", F.coalesce(F.bit_or("bit").over(before), F.lit(0)))
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).alias
    counts = marked.groupBy("part", "filter_order", "step", "bit").agg(
        total("n", ~fails & ~gone)("kept"), total("n", fails & ~gone)("removed"), total("n", fails & gone)("redundant"),
        total("n", F.expr("mask = bit"))("unique_fails"), total("good", fails & ~gone)("good_lost"), total("toxic", fails & ~gone)("toxic_lost"),
    )
    whole = Window.partitionBy("part", "bit")
    return counts.withColumn("shapley", F.sum("removed").over(whole)).select("part", "filter_order", F.col("step").cast("int").alias("step"), *COUNTS)


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The interactions of the five filters over ``docs``."""
    return interactions(mask_cells(docs, labels, **columns))

"""Operator 13: SimHash near-dedup by balls that meet in the middle.

1. A fingerprint has a bit for each bit that over half the XXH64 hashes of a text's shingles have. Texts of one fingerprint go on as one.
2. Two fingerprints differ in at most 2 * r bits if, and only if, some value lies within r bits of both. So every
   fingerprint emits its variants, all values within half the radius, and fingerprints that share a variant link.
3. The variants meet by their first bits. A row (variant so far, fingerprint, flips left) is sent for every choice of flips among the first
   ``depth`` bits, and the task that gets it adds the flips among the others: variants that go to one task travel as
   one row, some 100 rows in place of 2,081. ``depth`` grows with the logarithm of the number of fingerprints.
4. A task sorts the variants of a few prefixes at a time; only values that occur twice are traced back to their fingerprints, which are
   verified and linked to the smallest one of their task's class: as many edges as fingerprints, never pairs.
5. A prefix whose variants are more than ``most`` (a large group of near copies) is not expanded by one task: its rows are sent on by
   more bits, again and again, up to all 64, where a prefix is one variant and has at most one row for each value of its ball.
6. Edges of all tasks are joined by large-star and small-star.

Defined results: a null text is empty; texts without words have fingerprint zero and link like others; repeated rows are kept; a row with
a null id has a null component and makes no link; rows of one id with several texts give the id's links to each of them (its component is the
smallest id reachable through any); an empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.components import connected_components
from storyloom.llm.runtime import source, write_table
from storyloom.llm.vectext import U, chunks, record

BITS, SEED = 64, 42
#: fingerprints of a prefix that the first depth aims at, and the bits that a further depth adds
MEAN, MORE = 256, 12
#: variants of one prefix that a task expands at most, and variants that it sorts at once
MOST, AT_ONCE = 1 << 21, 1 << 21
#: shingles that are hashed at once; byte lanes count up to 255
BLOCK, LANE = 1 << 16, 255
LANES = U(0x0101010101010101)
_PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])
_SENT = pa.schema([("prefix", pa.int64()), ("variant", pa.int64()), ("print", pa.int64()), ("left", pa.int32())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, by lanes of eight bytes."""
    out = np.zeros(BITS, np.int64)
    if len(hashes):
        starts = np.arange(0, len(hashes), LANE)
        for i in range(8):
            lanes = np.add.reduceat((hashes >> U(i)) & LANES, starts)
            out[i::8] = np.ascontiguousarray(lanes).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of a text; hashes are counted a block at a time."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    space = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    start = np.concatenate([[0], space + 1])
    end = np.concatenate([space, [len(line)]])
    n = max(1, len(words) - shingle + 1)
    start, end = start[:n], end[min(shingle, len(words)) - 1 :]
    counts = np.zeros(BITS, np.int64)
    for s in range(0, n, BLOCK):
        parts = [line[a:b] for a, b in zip(start[s : s + BLOCK].tolist(), end[s : s + BLOCK].tolist(), strict=True)]
        counts += bit_counts(np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(SEED)), U, len(parts)))
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def _prints(shingle: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            prints = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], U)
            yield record(_PRINTS, doc_id=b.column("doc_id"), print=prints.view(np.int64))

    return emit


def flips(low: int, high: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` bits among those from ``low`` to below ``high``, fewest bits first."""
    bits = [1 << i for i in range(low, high)]
    return np.array([sum(c) for k in range(min(most, len(bits)) + 1) for c in itertools.combinations(bits, k)], U)


def ball(bits: int, most: int) -> int:
    """How many masks of at most ``most`` of so many bits there are."""
    return sum(math.comb(bits, k) for k in range(most + 1))


def _send(done: int, depth: int, radius: int):
    """Rows with all flips among the bits after the first ``done``, up to ``depth``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [flips(BITS - depth, BITS - done, r) for r in range(radius + 1)]
        used = [np.bitwise_count(m).astype(np.int32) for m in masks]
        for b in batches:
            variant, own = (b.column(c).to_numpy().view(U) for c in ("variant", "print"))
            left = b.column("left").to_numpy()
            for r in range(radius + 1):
                at = np.flatnonzero(left == r)
                if not len(at):
                    continue
                v = (variant[at, None] ^ masks[r][None, :]).ravel()
                prefix = v >> U(BITS - depth)
                yield record(_SENT, prefix=prefix.view(np.int64), variant=v.view(np.int64), print=np.repeat(own[at], len(masks[r])).view(np.int64), left=(r - np.broadcast_to(used[r], (len(at), len(used[r])))).ravel())

    return emit


def classes(value: np.ndarray, own: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that link prints which share a value to the smallest print of their class. ``value`` and ``own`` go together, a row for each variant."""
    order = np.lexsort((own, value))
    value, own = value[order], own[order]
    heads = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    first = np.repeat(own[heads], np.diff(np.concatenate([heads, [len(own)]])))
    if (np.bitwise_count(first ^ own) > 2 * radius).any():
        raise AssertionError("prints that share a variant lie within the radius")
    names, x = np.unique(np.concatenate([first, own]), return_inverse=True)
    a, b = x[: len(own)], x[len(own) :]
    label = np.arange(len(names))
    while True:  # each round every print takes the least label among those it shares a value with
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(names)))
    return list(zip(names[other].tolist(), names[label[other]].tolist(), strict=True))


def _meet(depth: int, radius: int):
    """Edges of the prefixes of a partition, which come in order."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [flips(0, BITS - depth, r) for r in range(radius + 1)]
        weight = np.array([len(m) for m in masks])

        def expand(variant: np.ndarray, own: np.ndarray, left: np.ndarray) -> pa.RecordBatch | None:
            groups = [np.flatnonzero(left == r) for r in range(radius + 1)]
            spread = lambda: ((variant[at, None] ^ masks[r][None, :], at) for r, at in enumerate(groups) if len(at))
            every = np.sort(np.concatenate([v.ravel() for v, _ in spread()]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            del every
            if not len(twice):
                return None
            values, prints = [], []
            for v, at in spread():
                place = np.minimum(np.searchsorted(twice, v), len(twice) - 1)
                row, col = np.nonzero(twice[place] == v)
                values.append(v[row, col])
                prints.append(own[at[row]])
            found = np.array(classes(np.concatenate(values), np.concatenate(prints), radius), U).reshape(-1, 2).view(np.int64)
            return record(_EDGES, a=found[:, 0], b=found[:, 1])

        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append((b.column("prefix").to_numpy(), *(b.column(c).to_numpy().view(U) for c in ("variant", "print")), b.column("left").to_numpy()))
            size += int(weight[held[-1][3]].sum())
            if size < AT_ONCE:
                continue
            prefix, variant, own, left = (np.concatenate([h[k] for h in held]) for k in range(4))
            cut = int(np.searchsorted(prefix[::-1] != prefix[-1], True))  # rows of the last prefix wait for more
            whole = slice(0, len(prefix) - cut)
            if whole.stop:
                if (out := expand(variant[whole], own[whole], left[whole])) is not None:
                    yield out
            held = [(prefix[whole.stop :], variant[whole.stop :], own[whole.stop :], left[whole.stop :])]
            size = int(weight[held[0][3]].sum())
        if held and len(held[0][0]):
            if (out := expand(*(np.concatenate([h[k] for h in held]) for k in (1, 2, 3)))) is not None:
                yield out

    return emit


def links(prints: DataFrame, distance: int = 4, mean: int = MEAN, most: int = MOST) -> DataFrame:
    """(a, b): links between distinct prints that differ in at most ``distance`` bits, enough of them to join all that are connected."""
    if distance % 2:
        raise ValueError("the radius must be even: both sides take half of it")
    radius = distance // 2
    n = prints.count()
    depth, done = min(BITS, max(1, math.ceil(math.log2(max(2, n / mean))))), 0
    rows = prints.select(F.col("print").alias("variant"), "print", F.lit(radius).alias("left"))
    found = None
    while True:
        sent = rows.mapInArrow(_send(done, depth, radius), "prefix long, variant long, print long, left int")
        weight = F.element_at(F.array(*[F.lit(ball(BITS - depth, r)) for r in range(radius + 1)]), F.col("left") + 1)
        heavy = write_table(sent.groupBy("prefix").agg(F.sum(weight).alias("size")).where(F.col("size") > most).select("prefix"), "heavy")
        several = depth < BITS and not heavy.isEmpty()
        light = sent.join(heavy, "prefix", "left_anti") if several else sent
        met = write_table(light.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_meet(depth, radius), "a long, b long"), "met")
        found = met if found is None else found.unionByName(met)
        if not several:
            return found
        rows = write_table(sent.join(heavy, "prefix", "left_semi").select("variant", "print", "left"), "open")
        done, depth = depth, min(BITS, depth + MORE)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, shingle: int = 4, **limits: int) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``."""
    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    known = write_table(src.mapInArrow(_prints(shingle), "doc_id long, print long"), "prints")
    named = known.where("doc_id is not null")
    least = write_table(named.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    # an id with several texts links their prints
    several = named.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low <> high").select("doc_id", "low")
    own = named.join(several, "doc_id").select(F.col("print").alias("a"), F.col("low").alias("b")).distinct()
    near = connected_components(links(least.select("print"), distance, **limits).unionByName(own))
    joined = write_table(least.join(near, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("component", "print").alias("comp")), "joined")
    first = write_table(joined.groupBy("comp").agg(F.min("least").alias("component_id")), "first")
    where = write_table(joined.join(first, "comp").select(F.col("print").alias("p"), "component_id"), "named")
    out = known.join(where, F.col("print") == F.col("p"), "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))

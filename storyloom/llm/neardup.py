"""Operator 2: MinHash near-dedup with banding, signature verification, exact confirmation and components.

1. Texts with one normal form (lower-cased words) collapse to one node, so a group of thousands of exact copies goes on as one text.
2. Each text has ``bands * rows`` minima of universal (multiply-shift) hashes over its distinct shingles, one bucket a
   band. Each member of a bucket is held against the bucket's smallest member on full shingle sets - as many edges as members, never pairs -
   and what links collapses by alternating large-star and small-star.
3. Buckets whose members now lie in one component are done. In the others each member is held against a member that
   the bucket's hash picks, ``PIVOTS`` times, and what links collapses again: a large group of near copies becomes one component this way, with
   edges as many as members.
4. In the buckets that are still open, members of different components meet by their signatures. Buckets that share members form a
   group (components of member-to-smallest-member edges); its members meet once, all together, or bucket by bucket, each pair
   in its first shared bucket only, whichever moves fewer rows. They meet by like size (cells of neighbouring size classes), those of the
   cell's main component with the rest, and the rest with each other, dealt by hash into blocks of about ``block`` texts, two blocks a
   task. A task returns a spanning forest of the pairs that may link. These forests make groups, which meet once more in the same way, now with
   their full sets, and in smaller blocks where these hold more than ``BYTES``; links are confirmed, and a task returns a spanning forest of them.
5. Large-star and small-star join the components that these links connect.

With 40 bands of 6 rows a pair at similarity 0.85 is missed with a chance under 1e-8. Signatures drop a pair only
where their estimate lies five standard deviations below the limit.

All joins are between tables, so Spark can split them where a bucket, a text or a component is hot.

Defined results: text without words, empty or null, has no shingles and links with nothing; fewer words than
a shingle count as one shingle; rows with a null id are kept and link with nothing (component null); a repeated row
(one id twice) is one node, and both rows get its component; so do one id's different texts, each with the links of its own words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.components import connected_components
from storyloom.llm.runtime import counted, few, source, write_table
from storyloom.llm.vectext import GRAM, U, Words, chunks, mix, record, stream

#: rounds in which the members of open buckets meet one that their bucket picks
PIVOTS = 1
#: texts of a block (some 450 bytes each without their sets), and bytes of a block's sets
BLOCK, BYTES = 2048, 16 << 20
#: a row with a set counts as so many rows where tasks are dealt
SET_ROWS = 20
#: minima of which the low byte is kept as a text's signature
SIGNATURE = 128
_SKETCH = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])
_SETS = pa.schema([("digest", pa.binary()), ("shingles", pa.list_(pa.int64()))])


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, ordered by row."""
    at, h = words.grams(k)
    row = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(short):
        pre = GRAM.prefix(words.hash)
        h = np.concatenate([h, GRAM.slices(pre, words.first[short], words.first[short] + words.count[short])])
        row = np.concatenate([row, short])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def signatures(row: np.ndarray, h: np.ndarray, n_hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles and their minima (rows x hashes, 32 bit)."""
    rows, head = np.unique(row, return_index=True)
    a, b = stream(101, n_hashes) | U(1), stream(202, n_hashes)
    out = np.empty((len(rows), n_hashes), np.uint32)
    if len(rows):
        for j in range(n_hashes):
            out[:, j] = np.minimum.reduceat(((h * a[j] + b[j]) >> U(32)).astype(np.uint32), head)
    return rows, out


def digests(w: Words) -> list[bytes | None]:
    """A 128-bit digest of each row's words; null without words."""
    raw, first, last = w.buf.tobytes(), w.first[:-1], w.first[1:]
    return [hashlib.blake2b(b" ".join(raw[w.start[f] : w.end[t - 1]].split()), digest_size=16).digest() if t > f else None for f, t in zip(first, last, strict=True)]


def _sketch(k: int, bands: int, rows_each: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = Words(batch.column("text"), lower=True)
            row, h = shingle_sets(w, k)
            who, sig = signatures(row, h, bands * rows_each)
            salt = stream(303, bands)
            keys = np.empty((len(who), bands), np.int64)
            for j in range(bands):
                acc = np.full(len(who), salt[j], U)
                for i in range(rows_each):
                    acc = mix(acc ^ sig[:, j * rows_each + i].astype(U)) * U(0x9E3779B97F4A7C15)
                keys[:, j] = acc.view(np.int64)
            digest = digests(w)
            n = np.bincount(row, minlength=batch.num_rows)
            ends = np.concatenate([[0], np.cumsum(n > 0)]) * bands
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel()))
            low = np.ascontiguousarray(sig[:, :SIGNATURE].astype(np.uint8))
            small = dict(zip(who.tolist(), (x.tobytes() for x in low), strict=True))
            yield record(_SKETCH, doc_id=batch.column("doc_id"), digest=pa.array(digest, pa.binary()), n_shingles=n.astype(np.int64), bands=lists, sig=pa.array([small.get(i) for i in range(batch.num_rows)], pa.binary()))

    return emit


def _sets(k: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = Words(batch.column("text"), lower=True)
            row, h = shingle_sets(w, k)
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield record(_SETS, digest=pa.array(digests(w), pa.binary()), shingles=pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(h.view(np.int64))))

    return emit


class Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def least_share(percent: int, n: int = SIGNATURE) -> float:
    """The share of equal minima that a pair at the limit falls short of once in millions."""
    return max(0.0, percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / n) ** 0.5)


def _similar(percent: int):
    """Pairs whose signatures allow a link."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sig", "p_sig"))
            stay = (x == y).mean(axis=1) >= least_share(percent) if b.num_rows else np.zeros(0, bool)
            yield b.select(["digest", "p"]).filter(pa.array(stay, pa.bool_()))

    return emit


class Rows:
    """Columns of some tasks' rows as arrays; components are numbered."""

    def __init__(self, table: pa.Table) -> None:
        get = lambda c: table.column(c).combine_chunks()
        self.sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(table.num_rows, -1)
        self.bands = get("bands").flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        self.block, self.n = (get(c).to_numpy(zero_copy_only=False) for c in ("block", "n"))
        self.upper = get("upper").to_numpy(zero_copy_only=False).astype(bool)
        self.key = get("key")
        self.names = table.column("comp").to_pylist()
        number: dict[bytes, int] = {}
        self.part = np.array([number.setdefault(c, len(number)) for c in self.names], np.int64)
        self.digest = table.column("digest")
        self.shingles = get("shingles") if "shingles" in table.column_names else None

    def likely(self, start: int, end: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each text of the task in rows [start, end) with the later ones that it may link with: of another component, in the other block where there
        are two, not both of the upper size class, of a size that allows it, with signatures within five deviations and with a shared
        bucket (where there is a ``key``, with that as the first one)."""
        key = self.key[start].as_py()
        two = self.block[start:end].min() != self.block[start:end].max()
        least = least_share(percent)
        for i in range(start, end - 1):
            own = slice(i + 1, end)
            lo, hi = np.minimum(self.n[own], self.n[i]), np.maximum(self.n[own], self.n[i])
            fit = (self.part[own] != self.part[i]) & (100 * lo >= percent * hi)
            if self.upper[i]:
                fit &= ~self.upper[own]
            if two:
                fit &= self.block[own] != self.block[i]
            other = np.flatnonzero(fit) + i + 1
            if len(other):
                other = other[(self.sig[other] == self.sig[i]).mean(axis=1) >= least]
            if len(other):
                shared = self.bands[other] == self.bands[i]
                other = other[shared.any(axis=1) if key is None else self.bands[i][shared.argmax(axis=1)] == key]
            if len(other):
                yield i, other

    def candidates(self, start: int, end: int, percent: int) -> list[tuple[bytes, bytes]]:
        """A spanning forest, over the task's texts, of the pairs that may link."""
        forest = Forest(end - start)
        return [(self.digest[i].as_py(), self.digest[int(j)].as_py()) for i, other in self.likely(start, end, percent) for j in other if forest.join(i - start, int(j) - start)]

    def links(self, start: int, end: int, percent: int) -> list[tuple[bytes, bytes]]:
        """A spanning forest, over the components of the task's texts, of links confirmed on full sets."""
        forest, out, sets = Forest(int(self.part.max()) + 1), [], {}

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = self.shingles[i].values.to_numpy()
            return sets[i]

        for i, other in self.likely(start, end, percent):
            for j in map(int, other):
                if forest.find(self.part[i]) == forest.find(self.part[j]):
                    continue
                x, y = shingles(i), shingles(j)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    forest.join(self.part[i], self.part[j])
                    out.append((self.names[i], self.names[j]))
        return out


def _each_task(rows: DataFrame, percent: int, what: str) -> DataFrame:
    """(a, b) of all tasks: rows of a task come together by their key, and tasks follow each other in a partition, so that small ones cost little."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

        def done(table: pa.Table) -> pa.RecordBatch:
            task = np.array(table.column("task").to_pylist(), object)
            edge = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            r = Rows(table)
            found = [x for s, e in zip(edge, edge[1:], strict=False) if e - s > 1 for x in getattr(r, what)(s, e, percent)]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], schema=schema)

        for b in batches:
            if not b.num_rows:
                continue
            if held and held[-1].column("task")[-1].as_py() == b.column("task")[b.num_rows - 1].as_py():
                held.append(b)  # one task goes on through the whole batch
                continue
            task = b.column("task").to_pylist()
            last = next(i for i in range(len(task) - 1, -1, -1) if i == 0 or task[i - 1] != task[-1])
            held.append(b.slice(0, last))
            if held := [h for h in held if h.num_rows]:
                yield done(pa.Table.from_batches(held))
            held = [b.slice(last)]
        if held:
            yield done(pa.Table.from_batches(held))

    keyed = rows.withColumn("task", F.md5(F.concat_ws(":", "place", "cell", "lo", "hi"))).drop("place", "cell", "lo", "hi")
    return keyed.repartition("task").sortWithinPartitions("task").mapInArrow(emit, "a binary, b binary")


def _tasks(rows: DataFrame, n_rows: int, percent: int, block: int, full: bool = False) -> DataFrame:
    """``rows`` (place, key, digest, n, comp), at most ``n_rows``, dealt to tasks: with ``cell``, ``upper``, ``block`` and a task's blocks ``lo`` and ``hi``. ``full``: sets come along, and a block holds ``BYTES`` of them at most, or one text."""
    step = 1.001 * math.log(100 / percent) if percent < 100 else 1e-9
    size_class = F.floor(F.log(F.col("n")) / step)
    # cell c compares texts of size class c with each other and with those of class c + 1
    two = F.array(F.struct(size_class.alias("cell"), F.lit(False).alias("upper")), F.struct((size_class - 1).alias("cell"), F.lit(True).alias("upper")))
    cells = write_table(rows.select("place", "key", "digest", "comp", "n", F.explode(two).alias("x")).select("place", "key", "digest", "comp", "n", "x.*"), "cells")
    each = few(cells.groupBy("place", "cell", "comp").agg(F.count("*").alias("size"), F.max("n").alias("n")), 2 * n_rows)
    sizes = each.groupBy("place", "cell").agg(F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("all"), F.max("n").alias("n")).where("all > main.size")
    texts = F.least(F.lit(block), F.greatest(F.lit(1), F.floor(F.lit(BYTES // 8) / F.col("n")))) if full else F.lit(block)
    sizes = write_table(few(sizes, 2 * n_rows).select("place", "cell", F.col("main.comp").alias("main"), F.ceil(F.col("main.size") / texts).cast("int").alias("main_blocks"), F.ceil((F.col("all") - F.col("main.size")) / texts).cast("int").alias("rest_blocks")), "sizes")
    dealt = cells.join(sizes, ["place", "cell"]).withColumn("is_main", F.expr("comp = main"))
    dealt = dealt.withColumn("block", F.expr("case when is_main then rest_blocks + pmod(xxhash64(digest), main_blocks) else pmod(xxhash64(digest), rest_blocks) end").cast("int"))
    # the rest meets all blocks, the main component's blocks meet the rest's
    pairs = F.expr("transform(sequence(0, case when is_main then rest_blocks - 1 else rest_blocks + main_blocks - 1 end), o -> named_struct('lo', least(block, o), 'hi', greatest(block, o)))")
    return dealt.select("place", "key", "cell", "digest", "comp", "n", "upper", "block", F.explode(pairs).alias("p")).select("place", "key", "cell", "digest", "comp", "n", "upper", "block", "p.*")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """(a, b): the pairs (digest, p), ``rows`` at most, that link on full sets."""
    first = write_table(few(pairs.join(sets, "digest").select("digest", "p", F.col("shingles").alias("x")), SET_ROWS * rows), "pairs")
    both = first.join(sets.select(F.col("digest").alias("p"), F.col("shingles").alias("y")), "p").withColumn("both", F.size(F.array_intersect("x", "y")))
    return few(both.where(f"100 * both >= {percent} * (size(x) + size(y) - both)").select(F.col("digest").alias("a"), F.col("p").alias("b")), SET_ROWS * rows)


def _open(members: DataFrame, near: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """(key, digest, n, comp): members of buckets that hold several components, and their number; ``rows``: ``members`` at most."""
    placed = write_table(few(members.join(near, F.col("digest") == F.col("node"), "left").select("key", "digest", "n", F.coalesce("component", "digest").alias("comp")), rows), "placed")
    several = few(placed.groupBy("key").agg((F.min("comp") < F.max("comp")).alias("open")).where("open").select("key"), rows)
    return counted(few(placed.join(write_table(several, "open"), "key"), rows), "members")


def _places(members: DataFrame, block: int, rows: int) -> DataFrame:
    """(place, key, digest, n, comp): the members of each group of open buckets that share members, once (key null) or once for each bucket, whichever is fewer rows in blocks."""
    heads = write_table(few(members.groupBy("key").agg(F.min("digest").alias("head"), F.count("*").alias("size")), rows), "open_heads")
    grp = write_table(connected_components(members.join(heads, "key").select(F.col("digest").alias("a"), F.col("head").alias("b")).distinct(), rows=rows), "buckets")
    own = write_table(few(members.join(grp, F.col("digest") == F.col("node")).select("key", "digest", "n", "comp", F.col("component").alias("grp")), rows), "grouped")
    once = few(own.select("grp", "digest", "n", "comp").distinct(), rows)
    blocks = lambda n: F.col(n) * F.ceil(F.col(n) / block)
    apart = few(own.groupBy("grp", "key").agg(F.count("*").alias("m")), rows).groupBy("grp").agg(F.sum(blocks("m")).alias("apart"))
    together = once.groupBy("grp").agg(F.count("*").alias("m")).select("grp", blocks("m").alias("together"))
    split = write_table(few(few(apart, rows).join(few(together, rows), "grp").where("apart < together").select(F.col("grp").alias("g")), rows), "split")
    whole = once.join(split, F.col("grp") == F.col("g"), "left_anti").select(F.hex("grp").alias("place"), F.lit(None).cast("long").alias("key"), "digest", "n", "comp")
    return few(whole.unionByName(own.join(split, F.col("grp") == F.col("g"), "left_semi").select(F.concat(F.lit("bucket "), F.col("key").cast("string")).alias("place"), "key", "digest", "n", "comp")), rows)


def _pivot_links(members: DataFrame, one: DataFrame, sets: DataFrame, percent: int, seed: int, rows: int) -> DataFrame:
    """(a, b): members that link with the one of another component that their bucket picks."""
    pick = F.min(F.struct(F.xxhash64("digest", "key", F.lit(seed)).alias("h"), F.col("digest").alias("p"), F.col("n").alias("p_n"), F.col("comp").alias("p_comp")))
    picked = write_table(few(members.groupBy("key").agg(pick.alias("x")).select("key", "x.*").drop("h"), rows), "picked")
    pairs = members.join(picked, "key").where("comp <> p_comp").where(f"100 * least(n, p_n) >= {percent} * greatest(n, p_n)").select("digest", "p").distinct()
    signed = few(pairs, rows).join(one.select("digest", "sig"), "digest").join(one.select(F.col("digest").alias("p"), F.col("sig").alias("p_sig")), "p")
    likely, n = counted(few(signed, rows).mapInArrow(_similar(percent), "digest binary, p binary"), "similar")
    return _confirmed(likely, sets, percent, n)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, shingle: int = 5, bands: int = 40, rows: int = 6, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``."""
    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    sketch, n_docs = counted(src.mapInArrow(_sketch(shingle, bands, rows), "doc_id long, digest binary, n_shingles long, bands array<long>, sig binary"), "sketch")
    named = sketch.where("digest is not null and doc_id is not null")
    one = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    one, n_texts = counted(few(one, SET_ROWS * n_docs), "texts")
    members = one.select("digest", "n", F.explode("bands").alias("key"))
    least = F.min(F.struct("digest", "n"))
    heads = members.groupBy("key").agg(least.alias("x"), F.count("*").alias("size")).where("size > 1").select("key", F.col("x.digest").alias("head"), F.col("x.n").alias("head_n"), "size")
    heads = write_table(few(heads, bands * n_texts), "heads")
    shared, n_shared = counted(few(members.join(heads.select("key"), "key"), bands * n_texts), "members")
    reps = few(few(shared.select("digest").distinct(), n_texts).join(one.select("digest", "rep"), "digest").select(F.col("rep").alias("doc_id")).distinct(), n_texts)
    # an id's other texts come along, and repeated rows; one set for each text
    sets = few(src.join(reps, "doc_id", "left_semi"), SET_ROWS * n_docs).mapInArrow(_sets(shingle), "digest binary, shingles array<long>")
    sets = write_table(few(sets.where("size(shingles) > 0").groupBy("digest").agg(F.first("shingles").alias("shingles")), SET_ROWS * n_docs), "sets")
    stars = shared.join(heads, "key").where("digest <> head").where(f"100 * least(n, head_n) >= {percent} * greatest(n, head_n)").select("digest", F.col("head").alias("p"))
    stars = few(few(stars, n_shared).distinct(), n_shared)
    near = write_table(connected_components(_confirmed(stars, sets, percent, n_shared), rows=n_shared), "near")
    # pairs with a bucket's smallest member are done
    left, n_left = _open(few(shared.join(heads.where("size > 2"), "key").where("digest <> head").select("key", "digest", "n"), n_shared), near, n_shared)
    for seed in range(PIVOTS):
        more = _pivot_links(left, one, sets, percent, seed, n_left)
        near = write_table(connected_components(more.unionByName(near.select(F.col("node").alias("a"), F.col("component").alias("b"))), rows=n_left + n_texts), "near")
        left, n_left = _open(left.drop("comp"), near, n_left)

    comp = F.coalesce("component", "digest").alias("comp")
    marks = one.select("digest", "bands", "sig")
    likely_pairs = _each_task(_tasks(_places(left, block, n_left), n_left, percent, block).join(marks, "digest"), percent, "candidates")
    groups = connected_components(likely_pairs).select(F.col("node").alias("digest"), F.hex("component").alias("place"), F.lit(None).cast("long").alias("key"))
    groups = few(groups.join(near.withColumnRenamed("component", "_c"), F.col("digest") == F.col("node"), "left").join(one.select("digest", "n"), "digest").select("place", "key", "digest", "n", F.coalesce("_c", "digest").alias("comp")), n_texts)
    groups, n_groups = counted(groups, "groups")
    links = _each_task(_tasks(groups, n_groups, percent, block, full=True).join(marks, "digest").join(sets, "digest"), percent, "links")

    where = write_table(few(one.select("digest", "rep").join(near, F.col("digest") == F.col("node"), "left").select("digest", "rep", comp), n_texts), "where")
    # an id with several texts links the components of all of them
    several = few(named.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id"), n_docs)
    own = write_table(few(named.select("doc_id", "digest").join(several, "doc_id").join(where.select("digest", "comp"), "digest").select("doc_id", "comp").distinct(), n_docs), "own")
    own = own.join(few(own.groupBy("doc_id").agg(F.min("comp").alias("b")), n_docs), "doc_id").select(F.col("comp").alias("a"), "b")
    wide = connected_components(links.unionByName(few(own, n_docs)))
    joined = write_table(few(where.join(wide, F.col("comp") == F.col("node"), "left").select("digest", "rep", F.coalesce("component", "comp").alias("comp")), n_texts), "joined")
    least_id = write_table(few(joined.groupBy("comp").agg(F.min("rep").alias("component_id")), n_texts), "least")
    named_by = write_table(few(joined.join(least_id, "comp").select("digest", "component_id"), n_texts), "named")
    out = sketch.join(named_by, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

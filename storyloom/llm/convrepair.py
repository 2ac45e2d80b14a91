"""Operator 11: repair of conversation structure by cheapest edits.

A legal conversation has role initials ``(s?(ua)+)?``. Its rows, in order, are the layers of a graph with four states each (nothing yet, after
a system row, after a user's, after an assistant's). Arcs keep a row (0), give it the role user or assistant (1), delete it (2) or insert a row
without text (5); a truncated row that stays adds 5; blank rows and duplicates can only be deleted. Costs are small integers, so
distances to the end are found with Dial's bucket queue, and a walk along tight arcs, least letter first, gives the audit: the
cheapest edits' initials (D, I, K, R), the ASCII-least of all cheapest. In each state every letter leads to one state, so the audit fixes the repaired rows.

Scale: rows are range-partitioned by conversation, turn and place, so the ranges are even whatever a conversation's size. A conversation
inside one range is repaired there (patterns of short conversations are kept, up to a fixed number). The first and the last of a range may
go on in others, and one over ``HELD`` characters isn't held: their rows are written out and repaired by parts. A part is what a range
has of a conversation; it gives the least costs from each state to each (16 numbers), a conversation's parts add up to
the distances behind each part, each part is walked from all four states, and the states met choose among the walks. No task
holds more than a range's letters. Only ``digest`` reads a conversation's repaired texts in one stream, which SHA-256 asks for; it holds one row.

Defined results: a null turn comes first and counts for no gap; null roles and texts are one space (so is a null id's or turn's name in the damage); a
null id is one conversation; rows of one turn are ordered by a hash of role and text, so repeated rows stand together and all but the first are duplicates; an empty role is
no legal one; other roles keep their names where their initial is u, a or s and fits; conversations without rows have zeros and
empty audits; an empty table gives no rows; columns of other names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.llm.runtime import source, write_table
from storyloom.llm.tokenout import ranges

SPACE = " \t\n\v\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: the state that each initial leads to, by state: an initial that is not named can't be kept
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: the state that a row of a chosen role leads to, and that role
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
#: cost of each edit, and of a truncated row that stays
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
FAR = 1 << 40
END = (0, FAR, FAR, 0)
#: letters of a row: what may be done with it. Upper case marks a truncated row, x one that must go
LETTERS = "suaoSUAOx"
#: characters of one conversation that a task holds; patterns that a worker keeps, and their length
HELD, PATTERNS, PATTERN = 8 << 20, 1 << 15, 64
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def arcs(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state) of what may be done with a row, in the order of the edits' letters but for inserts."""
    yield "D", DELETE, state
    if letter == "x":
        return
    extra = CUT if letter.isupper() else 0
    if letter.lower() in KEEPS[state]:
        yield "K", KEEP + extra, KEEPS[state][letter.lower()]
    yield "R", REROLE + extra, NEXT[state]


BACK = {letter: [[(p, c) for p in range(4) for _, c, q in arcs(letter, p) if q == s] for s in range(4)] for letter in LETTERS}
BEFORE = [[p for p in range(4) if NEXT[p] == s] for s in range(4)]
FORWARD = {letter: [list(arcs(letter, s)) for s in range(4)] for letter in LETTERS}


def distances(letters: str, goal: tuple[int, ...] = END) -> list[list[int]]:
    """Least cost from each state before each row (and behind the last) to the goal, whose states have costs of their own. Dial's queue: one bucket a cost."""
    n = len(letters)
    dist = [[FAR] * 4 for _ in range(n + 1)]
    buckets: list[list[tuple[int, int]]] = [[] for _ in range(REROLE + INSERT + CUT)]
    waiting: dict[int, list[tuple[int, int]]] = {}
    for s, g in enumerate(goal):
        if g < FAR:
            dist[n][s] = g
            waiting.setdefault(g, []).append((n, s))
    at, left = min(goal), sum(map(len, waiting.values()))
    while left:  # no arc costs more than there are buckets, so they are used in turn
        bucket = buckets[at % len(buckets)]
        bucket += waiting.pop(at, [])
        while bucket:
            i, s = bucket.pop()
            left -= 1
            if dist[i][s] < at:
                continue
            behind = [(i, p, INSERT) for p in BEFORE[s]]
            if i:
                behind += [(i - 1, p, c) for p, c in BACK[letters[i - 1]][s]]
            for j, p, c in behind:
                if at + c < dist[j][p]:
                    dist[j][p] = at + c
                    buckets[(at + c) % len(buckets)].append((j, p))
                    left += 1
        at += 1
    return dist


def walk(letters: str, dist: list[list[int]], state: int = START, last: bool = True) -> tuple[str, list[int]]:
    """The least letters along tight arcs from a state, and all states met. Inserts behind the last row belong to the next part, if there is one."""
    edits, states, i, n = [], [state], 0, len(letters)
    while i < n or (last and dist[i][state]):
        here = dist[i][state]
        tight = [(e, q, i + 1) for e, c, q in FORWARD[letters[i]][state] if here == c + dist[i + 1][q]] if i < n else []
        if here == dist[i][NEXT[state]] + INSERT:
            tight.append(("I", NEXT[state], i))
        edit, state, i = min(tight)
        edits.append(edit)
        states.append(state)
    return "".join(edits), states


_known: dict[str, tuple[str, int]] = {}


def cheapest(letters: str) -> tuple[str, int]:
    """Audit and cost of a whole conversation."""
    found = _known.get(letters)
    if found is None:
        dist = distances(letters)
        found = walk(letters, dist)[0], dist[0][START]
        if len(letters) <= PATTERN:
            if len(_known) >= PATTERNS:
                _known.clear()
            _known[letters] = found
    return found


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave."""
    state, rows = START, iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = KEEPS[state][role[:1]] if edit == "K" else NEXT[state]
        yield (role if edit == "K" else ROLE[state]), text


# rows


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the damage of a test: a crc of id and turn drops, empties, strips, repeats or renames. ``copies`` is 0 for a dropped row."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    return rows.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"), F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def _letters(duplicate: Column) -> tuple[Column, Column]:
    """A row's letter, and its initial (o for any that no legal pair has)."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    stays = F.when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return F.when((F.col("fault") == "blank") | duplicate, "x").otherwise(stays), initial


def _faults(text: Column) -> Column:
    last = F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))
    return F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").otherwise("")


_OUT = "kind int, conv_id long, part int, seq long, turn long, role string, text string, fault string, copies int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in _OUT.split(", ")])
_RAW = ("conv_id", "turn", "role", "text", "fault", "copies")


class Conversation:
    """The rows of one conversation, as they come."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.rows, self.size = conv_id, [], 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.size += len(row[2]) + len(row[3]) + 64

    def result(self) -> dict:
        rows = [r for r in self.rows for _ in range(r[5])]
        seen: set[tuple[str, str]] = set()
        letters, count = [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text, fault, _ in rows:
            if fault != "blank":
                if (role, text) in seen:
                    fault = "duplicate"
                seen.add((role, text))
            if fault:
                count[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters.append("x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter)
        turns = {r[1] for r in rows if r[1] is not None}
        audit, cost = cheapest("".join(letters))
        out = "\n".join(f"{role}:{text}" for role, text in repaired(audit, ((r[2], r[3]) for r in rows)))
        return {
            "conv_id": self.conv_id, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **count, "illegal": illegal("".join(r[2][:1] or "o" for r in rows)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(out.encode()).hexdigest(),
        }


def _in_ranges(held: int):
    """Results (kind 0) of the conversations inside a range; the rows (kind 1) of the others."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, now, first, raw = TaskContext.get().partitionId(), 0, None, True, False

        def batch(done: list[dict], rows: list[tuple]) -> pa.RecordBatch:
            nonlocal seq
            out = [{"kind": 0, **d} for d in done]
            for r in rows:
                out.append({"kind": 1, "part": part, "seq": seq, **dict(zip(_RAW, r, strict=True))})
                seq += 1
            return pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

        for b in batches:
            done, rows = [], []
            for row in zip(*(b.column(c).to_pylist() for c in _RAW), strict=True):
                if now is None or now.conv_id != row[0]:
                    if now is not None:
                        if first or raw:  # the first may have begun in another range
                            rows += now.rows
                        else:
                            done.append(now.result())
                        first = False
                    now, raw = Conversation(row[0]), False
                now.add(row)
                if now.size > held:
                    rows, now.rows, now.size, raw = rows + now.rows, [], 0, True
            if done or rows:
                yield batch(done, rows)
        if now is not None and now.rows:
            yield batch([], now.rows)

    return emit


def _batch(rows: list[dict], ddl: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=ddl)


_KEY = [("conv_id", pa.int64()), ("part", pa.int32())]
_COSTS = pa.schema([*_KEY, ("costs", pa.list_(pa.int64())), ("illegal", pa.int64()), ("ends", pa.string())])
_GOALS = pa.schema([*_KEY, ("last", pa.bool_()), ("goal", pa.list_(pa.int64())), ("illegal", pa.int64())])
_LEFT = pa.list_(pa.struct([("at", pa.int64()), ("spot", pa.int64()), ("new_role", pa.string())]))
_WALKS = pa.schema([*_KEY, ("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string()), ("stay", _LEFT)])
_ENTRIES = pa.schema([*_KEY, ("entry", pa.int32())])


def _rows(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(b.column(c).to_pylist() for c in names), strict=True)


def illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least costs of a part from each state to each (four for each state reached), its illegal pairs and its first and last initial."""
    for b in batches:
        out = []
        for conv, part, letters, initials in _rows(b, "conv_id", "part", "letters", "initials"):
            costs = [c for e in range(4) for c in distances(letters, tuple(0 if s == e else FAR for s in range(4)))[0]]
            out.append({"conv_id": conv, "part": part, "costs": costs, "illegal": illegal(initials), "ends": initials[0] + initials[-1]})
        yield _batch(out, _COSTS)


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distances to the end behind each part of a conversation, from the costs of all its parts."""
    for b in batches:
        out = []
        for conv, parts in _rows(b, "conv_id", "parts"):
            goal, after = list(END), ""
            for p in reversed(parts):
                out.append({"conv_id": conv, "part": p["part"], "last": not after, "goal": goal, "illegal": p["illegal"] + illegal(p["ends"][1] + after)})
                goal = [min(FAR, *(p["costs"][4 * e + s] + goal[e] for e in range(4))) for s in range(4)]
                after = p["ends"][0]
        yield _batch(out, _GOALS)


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The walk through a part from each state from which the end can be reached, and the rows that it leaves."""
    for b in batches:
        for conv, part, last, letters, spots, goal in _rows(b, "conv_id", "part", "last", "letters", "spots", "goal"):
            dist, out = distances(letters, tuple(goal)), []
            for s in (s for s in range(4) if dist[0][s] < FAR):
                edits, states = walk(letters, dist, s, last)
                left, rows = [], iter(spots)
                for at, (edit, state) in enumerate(zip(edits, states[1:], strict=True)):
                    spot = None if edit == "I" else next(rows)
                    if edit != "D":
                        left.append({"at": at, "spot": spot, "new_role": None if edit == "K" else ROLE[state]})
                out.append({"conv_id": conv, "part": part, "entry": s, "exit": states[-1], "cost": dist[0][s], "edits": edits, "stay": left})
            yield _batch(out, _WALKS)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which the chosen walks enter each part."""
    for b in batches:
        out = []
        for conv, ways in _rows(b, "conv_id", "ways"):
            state, exits = START, {(w["part"], w["entry"]): w["exit"] for w in ways}
            for part in sorted({w["part"] for w in ways}):
                out.append({"conv_id": conv, "part": part, "entry": state})
                state = exits[part, state]
        yield _batch(out, _ENTRIES)


def _joined(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``a`` with the columns of ``b`` for equal conversations and keys; null ids are equal."""
    own = b.withColumnsRenamed({k: f"_{k}" for k in ("conv_id", *keys)})
    on = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return a.join(own, on, how).drop(*[f"_{k}" for k in ("conv_id", *keys)])


def _by_parts(rows: DataFrame) -> DataFrame:
    """Results of conversations whose ``rows`` (conv_id, part, seq and the rest) were not repaired inside a range."""
    each = rows.where("copies > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    each = each.withColumn("spot", 2 * F.col("seq") + F.col("copy")).withColumn("at", F.struct("part", "spot"))
    each = each.withColumn("seen", F.md5(F.concat_ws("\0", "role", "text").cast("binary")))
    firsts = each.where("fault <> 'blank'").groupBy("conv_id", "seen").agg(F.min("at").alias("first_at"))
    each = _joined(each, firsts, "seen", how="left")
    each = each.withColumn("duplicate", F.coalesce(F.expr("fault <> 'blank' and at > first_at"), F.lit(False)))
    letter, initial = _letters(F.col("duplicate"))
    each = write_table(each.select("conv_id", "part", "spot", "turn", "role", "text", "fault", "duplicate", letter.alias("letter"), initial.alias("initial")), "rows")

    listed = F.array_sort(F.collect_list(F.struct("spot", "letter", "initial"))).alias("all")
    parts = each.groupBy("conv_id", "part").agg(listed).select("conv_id", "part", F.col("all.spot").alias("spots"), F.array_join("all.letter", "").alias("letters"), F.array_join("all.initial", "").alias("initials"))
    parts = write_table(parts, "parts")
    costs = parts.mapInArrow(_matrices, "conv_id long, part int, costs array<long>, illegal long, ends string")
    together = costs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "costs", "illegal", "ends"))).alias("parts"))
    behind = write_table(together.mapInArrow(_behind, "conv_id long, part int, last boolean, goal array<long>, illegal long"), "goals")
    walks = _joined(parts, behind.drop("illegal"), "part").mapInArrow(_walks, "conv_id long, part int, entry int, exit int, cost long, edits string, stay array<struct<at:long,spot:long,new_role:string>>")
    walks = write_table(walks, "walks")
    met = walks.groupBy("conv_id").agg(F.collect_list(F.struct("part", "entry", "exit")).alias("ways")).mapInArrow(_met, "conv_id long, part int, entry int")
    chosen = write_table(_joined(walks, met, "part", "entry"), "edits")

    stay = chosen.select("conv_id", "part", F.explode("stay").alias("s")).select("conv_id", "part", "s.*")
    kept = _joined(stay, each.select("conv_id", "part", "spot", "role", "text"), "part", "spot", how="left")
    kept = kept.select("conv_id", "part", "at", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    shas = kept.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(_digests, "conv_id long, repaired_sha256 string")

    is_fault = lambda f: F.sum((F.expr(f)).cast("long"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    faults = each.groupBy("conv_id").agg(gaps.alias("gaps"), is_fault("fault = 'blank'").alias("blank"), is_fault("duplicate").alias("duplicate"), is_fault("fault = 'truncated' and not duplicate").alias("truncated"))
    pairs = behind.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    audits = chosen.groupBy("conv_id").agg(F.min_by("cost", "part").alias("cost"), F.array_join(F.array_sort(F.collect_list(F.struct("part", "edits")))["edits"], "").alias("audit"))
    out = rows.select("conv_id").distinct()
    for more in (faults, pairs, audits, shas):
        out = _joined(out, more, how="left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired rows, which come in order; one row is held."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    began, now, sha = False, None, hashlib.sha256()
    for b in batches:
        out = []
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if began and conv == now:
                sha.update(b"\n")
            else:
                if began:
                    out.append({"conv_id": now, "repaired_sha256": sha.hexdigest()})
                began, now, sha = True, conv, hashlib.sha256()
            sha.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if began:
        yield pa.RecordBatch.from_pylist([{"conv_id": now, "repaired_sha256": sha.hexdigest()}], schema=schema)


def repair(rows: DataFrame, held: int = HELD, partitions: int | None = None) -> DataFrame:
    """(conv_id, ``COUNTS``, audit, repaired_sha256) for each conversation of ``rows`` (conv_id, turn, role, text; each is there ``copies`` times if that column is given)."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1))
    src = source(rows, conv_id=("conv_id", "long"), turn=("turn", "long"), role=("role", "string"), text=("text", "string"), copies=("copies", "int"))
    n = partitions or ranges(src)
    text = F.when(F.col("copies") > 0, F.coalesce("text", F.lit(" "))).otherwise("")
    src = src.withColumns({"text": text, "role": F.coalesce("role", F.lit(" "))}).withColumn("fault", _faults(F.col("text")))
    # rows that are equal in all are dealt by where they are read
    keyed = src.withColumn("tie", F.xxhash64("role", "text")).withColumn("place", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(n, "conv_id", "turn", "tie", "place").sortWithinPartitions("conv_id", "turn", "tie", "place")
    done = write_table(ordered.select(*_RAW).mapInArrow(_in_ranges(held), _OUT), "repaired")
    inside = done.where("kind = 0").select("conv_id", *COUNTS, "audit", "repaired_sha256")
    return inside.unionByName(_by_parts(done.where("kind = 1").select("conv_id", "part", "seq", "turn", "role", "text", "fault", "copies")))

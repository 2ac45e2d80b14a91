"""Plain forms of the operators' contracts, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return SPACE.findall(text or "")


def substring_dedup(rows, size=35):
    ws = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + size]) for w in ws for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, ws, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_duplicates(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if (a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b)) or (same_id and a and b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        c = None if doc is None else min(x for x in groups[find(i)] if x is not None)
        out.append((doc, len(sets[i]), c, doc is None or doc == c))
    return out


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def quality(text):
    w = words(text)
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {k for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
)


def personal(text):
    spans = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m[0]))
    n = collections.Counter(s[3] for s in spans)
    return n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans).encode()).hexdigest()


def within(window, text, edits):
    """Whether some stretch of the text is within so many edits of the window: a bit vector per column, all columns in turn."""
    m = len(window)
    where = collections.defaultdict(int)
    for i, c in enumerate(window):
        where[c] |= 1 << i
    full = (1 << m) - 1
    up, down, score = full, 0, m
    for c in text:
        eq = where[c]
        x = (((eq & up) + up) ^ up) | eq | down
        hp, hn = (down | ~(x | up)) & full, up & x
        score += ((hp >> (m - 1)) & 1) - ((hn >> (m - 1)) & 1)
        if score <= edits:
            return True
        hp = (hp << 1) & full
        hn = (hn << 1) & full
        up, down = (hn | ~((eq | down) | hp)) & full, hp & (eq | down)
    return score <= edits


def simhashes(text, k=4):
    w = words((text or "").translate(LOWER))
    return [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])


def simhash(text, k=4):
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in simhashes(text, k)]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def joined(prints, distance):
    """The class of each print, by all pairs."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def simhash_groups(rows, distance=4):
    """rows with ids, one text an id."""
    prints = [simhash(t) for _, t in rows]
    of = joined(prints, distance)
    least = {}
    for (doc, _), c in zip(rows, of, strict=True):
        least[c] = min(doc, least.get(c, doc))
    return [(doc, f"{p:016x}", least[c]) for (doc, _), p, c in zip(rows, prints, of, strict=True)]


def filter_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic). Each document walked through each order."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    out, shapley = collections.Counter(), collections.Counter()
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for d, t, lang in docs:
        t, part = t or "", lang or ""
        w = words(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t],
        }
        for o in orders:
            gone = False
            for i, f in enumerate(o):
                here = out, (part, o, i + 1)
                hit = fails[f]
                for name, holds in (("kept", not hit and not gone), ("removed", hit and not gone), ("redundant", hit and gone), ("unique", hit and sum(fails.values()) == 1), ("good", hit and not gone and d in good), ("toxic", hit and not gone and d in toxic)):
                    here[0][(*here[1], name)] += holds
                shapley[part, f] += hit and not gone
                gone |= hit
    parts = {x[2] or "" for x in docs}
    names = ("kept", "removed", "redundant", "unique", "good", "toxic")
    return [(p, o, i + 1, *(out[p, o, i + 1, n] for n in names), shapley[p, o[i]]) for p in parts for o in orders for i in range(5)]


def damage(rows):
    """rows: (conv_id, turn, role, text) in order."""
    out = []
    for conv, turn, role, text in rows:
        conv_s, turn_s, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        hit = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def cheapest_edits(rows):
    """rows: (initial, must go, truncated). Least (cost, audit) by costs in order, and the states met."""
    import heapq

    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        last = roles[-1:]
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", i, roles + new))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles))
            if not gone:
                heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", i + 1, roles + new))
                if initial == new or (initial == "s" and not roles):
                    heapq.heappush(heap, (cost + 5 * cut, audit + "K", i + 1, roles + initial))


def conversations(rows):
    """rows: (conv_id, turn, role, text), damaged already or not, one text a turn; ``ids`` are all that had rows."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(damage([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, kinds, count = set(), [], collections.Counter()
        for _, _, role, text in mine:
            w = words(text)
            kind = "blank" if not w else "duplicate" if (role, text) in seen else "truncated" if w[-1][-1] not in ".!?" else ""
            seen.add((role, text))
            count[kind] += 1
            kinds.append((role[:1], kind in ("blank", "duplicate"), kind == "truncated"))
        turns = {r[1] for r in mine if r[1] is not None}
        cost, audit = cheapest_edits(kinds)
        left, state, todo = [], "", list(mine)
        for e in audit:
            _, _, role, text = (None, None, "", "") if e == "I" else todo.pop(0)
            if e != "D":
                new = {"u": "assistant"}.get(state, "user")
                role = role if e == "K" else new
                state = role[0]
                left.append(f"{role}:{text}")
        bad = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], bad, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out

"""Blocks that two texts share, as a recursive search for longest common blocks gives them, without comparing all places.

The longest block of two texts is taken (the earliest in the first, then in the second one), then the longest on its left and on its right, and so on.
Only blocks of at least ``least`` characters are wanted, so every one is part of a run of shared ``least``-grams on one diagonal: the runs are found once by sorting
the grams' hashes, and each step of the recursion clips them to its window. Texts whose repetitions make too many pairs of places take the longest block of
a window from a suffix automaton, in time linear in the window.
"""

from __future__ import annotations

import numpy as np

#: pairs of places with one gram that are listed at once; more go to the automaton
PAIRS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(x: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n-gram."""
    wide = x.astype(np.uint64)
    wide = (wide ^ (wide >> np.uint64(7))) * _BASE
    out = np.zeros(max(0, len(x) - n + 1), np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + wide[k : k + len(out)]
    return out


def _runs(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray | None:
    """Rows (start in a, start in b, size): all maximal stretches of at least ``least`` equal characters; None where there are too many pairs."""
    x, y = _grams(a, least), _grams(b, least)
    order = np.argsort(y, kind="stable")
    keys = y[order]
    lo, hi = np.searchsorted(keys, x, "left"), np.searchsorted(keys, x, "right")
    many = hi - lo
    total = int(many.sum())
    if total > PAIRS:
        return None
    i = np.repeat(np.arange(len(x)), many)
    j = order[np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(total)]
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    if not total:
        return np.zeros((0, 3), np.int64)
    new = np.ones(total, bool)
    new[1:] = (np.diff(j - i) != 0) | (np.diff(i) != 1)
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, total)) + least - 1
    rows = np.stack([i[heads], j[heads], size], axis=1)
    if any(not np.array_equal(a[s : s + n], b[t : t + n]) for s, t, n in rows.tolist()):
        return None  # two grams of one hash
    return rows


class Automaton:
    """The suffix automaton of a text: states by length, link, arcs and the place where their texts end first."""

    def __init__(self, text: str) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.link, self.size, self.end = [-1], [0], [0]
        last = 0
        for at, c in enumerate(text, 1):
            state = self._state({}, self.size[last] + 1, at)
            p = last
            while p >= 0 and c not in self.arcs[p]:
                self.arcs[p][c] = state
                p = self.link[p]
            if p < 0:
                self.link[state] = 0
            else:
                q = self.arcs[p][c]
                if self.size[q] == self.size[p] + 1:
                    self.link[state] = q
                else:
                    twin = self._state(dict(self.arcs[q]), self.size[p] + 1, self.end[q])
                    self.link[twin] = self.link[q]
                    while p >= 0 and self.arcs[p].get(c) == q:
                        self.arcs[p][c] = twin
                        p = self.link[p]
                    self.link[q] = self.link[state] = twin
            last = state

    def _state(self, arcs: dict[str, int], size: int, end: int) -> int:
        self.arcs.append(arcs)
        self.link.append(0)
        self.size.append(size)
        self.end.append(end)
        return len(self.size) - 1

    def longest(self, text: str) -> tuple[int, int, int]:
        """(start in ``text``, start in the automaton's text, size) of the longest common block: the earliest in the one, then in the other."""
        best, state, n = (0, 0, 0), 0, 0
        for at, c in enumerate(text, 1):
            while state and c not in self.arcs[state]:
                state = self.link[state]
                n = self.size[state]
            if c in self.arcs[state]:
                state, n = self.arcs[state][c], n + 1
            if n > best[2]:
                best = at - n, self.end[state] - n, n
        return best


def shared_blocks(a: str, b: str, least: int) -> list[tuple[int, int, int]]:
    """(start in a, start in b, size) of the blocks of at least ``least`` characters, in order."""
    if len(a) < least or len(b) < least:
        return []
    runs = _runs(codes(a), codes(b), least)
    out: list[tuple[int, int, int]] = []
    todo: list[tuple[int, int, int, int, np.ndarray | None]] = [(0, len(a), 0, len(b), runs)]
    while todo:
        a0, a1, b0, b1, own = todo.pop()
        if a1 - a0 < least or b1 - b0 < least:
            continue
        if own is None:
            i, j, n = Automaton(b[b0:b1]).longest(a[a0:a1])
            i, j = i + a0, j + b0
        else:
            cut = np.maximum(0, np.maximum(a0 - own[:, 0], b0 - own[:, 1]))
            size = np.minimum(own[:, 2] - cut, np.minimum(a1 - own[:, 0] - cut, b1 - own[:, 1] - cut))
            keep = size >= least
            own, cut, size = own[keep], cut[keep], size[keep]
            if not len(own):
                continue
            at = np.lexsort((own[:, 1] + cut, own[:, 0] + cut, -size))[0]
            i, j, n = int(own[at, 0] + cut[at]), int(own[at, 1] + cut[at]), int(size[at])
        if n < least:
            continue
        out.append((i, j, n))
        todo += [(a0, i, b0, j, own), (i + n, a1, j + n, b1, own)]
    return sorted(out)

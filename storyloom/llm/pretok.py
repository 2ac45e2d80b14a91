"""Vectorised pre-tokenisation for the public BPE vocabularies, with a bounded cache from pre-token to result.

Texts whose characters all lie in ranges where Python's and the library's Unicode tables agree are split with array
operations; any other text, and one with a special token's string, goes to the library whole. Both give the library's ids.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from storyloom.llm.vectext import Poly, U, flat, stream

O, L, N, S, SEP, ALIEN = 0, 1, 2, 3, 4, 9
_CHARS = Poly(51)
_VALUES = stream(61, 1 << 16)
# ranges of characters that are trusted, end exclusive
_COMMON = [(0x00, 0x1C), (0x20, 0x130), (0x131, 0x250), (0x400, 0x460), (0x2010, 0x2028), (0x2030, 0x205F), (0x20A0, 0x20BE), (0x4E00, 0x9FA6)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(1 << 16, ALIEN, np.uint8)
    lower = np.arange(1 << 16, dtype=np.uint32)
    for a, b in _COMMON:
        for c in range(a, b):
            cat = unicodedata.category(chr(c))
            kind[c] = S if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0) or cat[0] == "Z" else {"L": L, "N": N}.get(cat[0], O)
            lower[c] = ord(chr(c).lower())
    return kind, lower


_TABLES: list = []


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabularies: printable bytes are themselves, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = np.array([ord(c) for _, c in sorted(byte_letters().items())], np.uint16)


class Tokens:
    """Pre-tokens of an Arrow text column: ``doc`` row, ``hash``, ``start`` and ``end`` in ``chars``; ``whole``: rows left to the library."""

    def __init__(self, column: pa.Array, words_only: bool) -> None:
        if not _TABLES:
            _TABLES.extend(_tables())
        kinds, lower = _TABLES
        buf, off = flat(column)
        raw = buf.tobytes()
        chars = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
        n = len(off) - 1
        # a separator before each text and after the last
        place = np.arange(len(chars)) + np.repeat(np.arange(1, n + 1), np.diff(heads))
        cp = np.zeros(len(chars) + n + 1, np.uint32)
        cp[place] = chars
        seps = heads + np.arange(n + 1)
        kind = np.empty(len(cp), np.uint8)
        big = cp > 0xFFFF
        if big.any():
            cp = np.where(big, np.uint32(0xFFFF), cp)
        kind[:] = kinds[cp]
        kind[seps] = SEP
        bad = (kind == ALIEN) | ((cp == 60) & (np.append(cp[1:], 0) == 124))  # "<|" opens each special token
        self.whole = np.zeros(n, bool)
        if bad.any():
            self.whole[np.searchsorted(seps, np.flatnonzero(bad), "right") - 1] = True
        if words_only:
            cp = lower[cp]
        before = np.empty_like(kind)
        before[0] = SEP
        before[1:] = kind[:-1]
        solid = (kind != SEP) & (kind != S)
        start = (kind != before) & solid
        quote = np.flatnonzero(start & (cp == 39) & (kind == O))
        if not words_only:
            spaced = np.zeros(len(cp), bool)
            spaced[1:] = cp[:-1] == 32
            spaced &= before == S
            start &= ~spaced
            quote = quote[~spaced[quote]]
            blank = kind == S
            start |= blank & (before != S)
            after = np.append(kind[1:], SEP)
            start |= blank & (after != S) & (after != SEP)
        else:
            start |= kind == N
        if len(quote):
            one, two = cp[np.minimum(quote + 1, len(cp) - 1)], cp[np.minimum(quote + 2, len(cp) - 1)]
            size = np.where(np.isin(one, [115, 116, 109, 100]), 1, np.where(((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)), 2, 0))
            quote, size = quote[size > 0], size[size > 0]
            start[quote + 1] = False
            follow = quote + 1 + size
            start[follow[kind[follow] == L]] = True
        stop = start | (kind == SEP)
        if words_only:
            stop |= kind == S
        stops = np.flatnonzero(stop)
        ours = start[stops]
        self.start = stops[ours]
        ends = np.append(stops[1:], len(cp))
        self.end = ends[ours]
        self.doc = np.searchsorted(seps, self.start, "right") - 1
        if self.whole.any():
            keep = ~self.whole[self.doc]
            self.start, self.end, self.doc = self.start[keep], self.end[keep], self.doc[keep]
        self.chars = cp
        self.rows = n
        self.hash = _CHARS.slices_of(_VALUES, cp, self.start, self.end)

    def letters(self, which: np.ndarray) -> list[str]:
        """The byte letters of some pre-tokens."""
        size = self.end[which] - self.start[which]
        edge = np.concatenate([[0], np.cumsum(size)])
        cp = self.chars[np.repeat(self.start[which] - edge[:-1], size) + np.arange(edge[-1])]
        cuts = np.concatenate([[0], np.cumsum(1 + (cp > 0x7F) + (cp > 0x7FF))])[edge].tolist()
        whole = _LETTERS[np.frombuffer(cp.tobytes().decode("utf-32-le").encode(), np.uint8)].tobytes().decode("utf-16-le")
        return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Cache:
    """A direct-mapped table from hash to an array of numbers, of bounded size (some 9 MB). ``make``: a pre-token's byte letters to numbers."""

    def __init__(self, make: Callable[[str], list[int]], slots: int = 1 << 18, pool: int = 1 << 20) -> None:
        self.make, self.mask, self.room = make, U(slots - 1), pool
        self.key, self.at, self.size = np.zeros(slots, U), np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _add(self, items: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in items], np.int32)
        new = np.array([y for x in items for y in x], np.uint32)
        while self.used + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used : self.used + len(new)] = new
        at = self.used + np.cumsum(size) - size
        self.used += len(new)
        return at, size

    def find(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``pool`` and length for each pre-token. Valid until the next call."""
        if self.used > self.room:
            self.key[:] = 0
            self.used = 0
        h = tokens.hash
        slot = (h & self.mask).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            _, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            which = miss[first]
            a, s = self._add([self.make(x) for x in tokens.letters(which)])
            at[miss], size[miss] = a[back], s[back]
            self.key[slot[which]], self.at[slot[which]], self.size[slot[which]] = h[which], a, s
        return at, size


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary: the file is read once, and only the last vocabulary's encoder is kept."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """Ids of whole texts as ``tokenizers`` gives them with add_special_tokens=False."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.words_only = not isinstance(self.tok.pre_tokenizer, pre_tokenizers.ByteLevel)
        tokenize = self.tok.model.tokenize
        self.cache = Cache(lambda w: [t.id for t in tokenize(w)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's texts in order, and how many each text has."""
        t = Tokens(column, self.words_only)
        at, size = self.cache.find(t)
        total = int(size.sum())
        ids = self.cache.pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(total)]
        count = np.bincount(t.doc, size, t.rows).astype(np.int64)
        if t.whole.any():
            parts, edge = [], np.concatenate([[0], np.cumsum(count)])
            for i in range(t.rows):
                part = ids[edge[i] : edge[i + 1]]
                if t.whole[i]:
                    part = np.array(self.tok.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
                    count[i] = len(part)
                parts.append(part)
            ids = np.concatenate(parts)
        return ids, count

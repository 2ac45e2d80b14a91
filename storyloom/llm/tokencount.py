"""Operator 4: exact token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as one symbol a byte letter; the adjacent pair of lowest rank is popped from a heap and
merged, links and new pairs are updated, and the count is the initial symbols minus the merges. No ids are made.
Counts of pre-tokens are kept in a bounded table, so each worker merges a frequent word once.

Defined results: null counts as empty (0 bytes, 0 tokens); repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.pretok import Cache, Tokens
from storyloom.llm.runtime import source
from storyloom.llm.vectext import chunks, record

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


class Merger:
    """Token counts by the merges of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.words_only = spec["pre_tokenizer"]["type"] != "ByteLevel"
        self.path = path
        self._lib = None

    def count(self, letters: str) -> int:
        """Tokens of one pre-token."""
        sym = list(letters)
        if not sym:
            return 0
        sym[-1] += self.suffix
        n = len(sym)
        if n == 1:
            return 1
        rank = self.ranks.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if j >= n or sym[i] != a or sym[j] != b:
                continue  # one side has been merged away since
            sym[i], sym[j] = a + b, ""
            merges += 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[k]))
            if (h := left[i]) >= 0 and (r := rank((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h, sym[h], sym[i]))
        return n - merges

    def count_text(self, text: str) -> int:
        """Tokens of a whole text: the library splits it, the merges are ours."""
        if self._lib is None:
            from tokenizers import Tokenizer

            self._lib = Tokenizer.from_file(self.path)
        total = 0
        for part in re.split(f"({'|'.join(map(re.escape, self.special))})", text) if self.special else [text]:
            if part in self.special:
                total += 1
            elif part:
                part = self._lib.normalizer.normalize_str(part) if self._lib.normalizer else part
                total += sum(self.count(w) for w, _ in self._lib.pre_tokenizer.pre_tokenize_str(part))
        return total


_MERGERS: dict[str, tuple[Merger, Cache]] = {}


def counts(path: str, column: pa.Array) -> np.ndarray:
    """Token counts of a text column."""
    if path not in _MERGERS:
        m = Merger(path)
        _MERGERS[path] = m, Cache(lambda w: [m.count(w)])
    merger, cache = _MERGERS[path]
    t = Tokens(column, merger.words_only)
    at, _ = cache.find(t)
    out = np.bincount(t.doc, cache.pool[at], t.rows).astype(np.int64)
    for i in np.flatnonzero(t.whole):
        out[i] = merger.count_text(column[int(i)].as_py())
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            text = b.column("text")
            n = counts(tokenizer_path, text)
            size = np.array([len((x.as_py() or "").encode()) for x in text], np.int64)
            yield record(_OUT, doc_id=b.column("doc_id"), n_bytes=size, n_tokens=n, over_limit=n > limit)

    src = source(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    return src.mapInArrow(emit, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

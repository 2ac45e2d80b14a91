"""Which tokens of a rendered chat a model is trained on: those of replies, from behind the mark that opens one to the next mark of a request."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: what opens a request and a reply in the chat template
REQUEST, REPLY = "<|im_start|>user\n", "<|im_start|>assistant\n"


def reply_spans(text: str, request: str = REQUEST, reply: str = REPLY) -> list[tuple[int, int]]:
    """Character spans of replies; a reply with no request behind it goes to the end of the text."""
    out, at = [], 0
    while (start := text.find(reply, at)) >= 0:
        start += len(reply)
        end = text.find(request, start)
        end = len(text) if end < 0 else end
        out.append((start, end))
        at = end
    return out


def token_mask(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[int]:
    """1 for each token that lies in a span whole. Offsets and spans come in order."""
    out, k = [], 0
    for s, e in offsets:
        while k < len(spans) and spans[k][1] <= s:
            k += 1
        out.append(int(k < len(spans) and spans[k][0] <= s and e <= spans[k][1] and s < e))
    return out


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def reply_masks(chats: DataFrame, key: str, tokenizer_path: str, text: str = "text", request: str = REQUEST, reply: str = REPLY) -> DataFrame:
    """(key, at, token, mask) for each token of rendered chats: its place, its id, and whether it belongs to a reply.

    A null text has no tokens. A worker loads the tokenizer once; chats are encoded one by one, so it holds one chat's tokens and a batch of texts.
    """
    kind = dict(chats.dtypes)[key]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer_path).encode
        for b in batches:
            for i, x in enumerate(b.column("_text").to_pylist()):
                found = encode(x or "", add_special_tokens=False)
                n = len(found.ids)
                keys = b.column(key).take(pa.array([i] * n, pa.int64()))
                mask = token_mask(found.offsets, reply_spans(x or "", request, reply))
                yield pa.RecordBatch.from_arrays([keys, pa.array(range(n), pa.int32()), pa.array(found.ids, pa.int32()), pa.array(mask, pa.int32())], names=[key, "at", "token", "mask"])

    rows = chats.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(emit, f"{key} {kind}, at int, token int, mask int")

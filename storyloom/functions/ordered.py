"""Folds over ordered rows of each key, streamed: a task holds a key's state and a batch, never a key's rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


def stream_fold(rows: DataFrame, part: list[str], order: list[str], schema: str, start: Callable[[], Any], step: Callable[[Any, dict], Iterable[tuple]], finish: Callable[[Any, tuple], Iterable[tuple]] | None = None) -> DataFrame:
    """Rows of ``schema`` from ``step(state, row)`` for each row in order, and from ``finish(state, key)`` behind a key's last one. ``start`` makes a key's state.

    A key is one ordered chain, so it is one task's; its rows go by in Arrow batches.
    """
    from storyloom.plans.lineage import small_batches

    small_batches(rows.sparkSession)
    names = columns_of(schema)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key: tuple | None = None
        state: Any = None
        for f in frames:
            out: list[tuple] = []
            for row in f.to_dict("records"):
                own = tuple(None if pd.isna(row[p]) else row[p] for p in part)
                if key is None or own != key:
                    if key is not None and finish:
                        out += finish(state, key)
                    key, state = own, start()
                out += step(state, row)
            yield pd.DataFrame(out, columns=names)
        if key is not None and finish:
            yield pd.DataFrame([*finish(state, key)], columns=names)

    return rows.repartition(*part).sortWithinPartitions(*part, *order).mapInPandas(apply, schema)


def columns_of(schema: str) -> list[str]:
    """The names in a DDL string, cut at commas outside brackets."""
    depth, at, out = 0, 0, []
    for i, c in enumerate(f"{schema},"):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[at:i].split()[0])
            at = i + 1
    return out

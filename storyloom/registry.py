"""Every query of the reference's own operators, collected from the query modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("messages", "texts", "annotation", "records", "stories", "files", "outputs", "calls")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in MODULES:
        out |= import_module(f"storyloom.queries.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        out |= import_module(f"storyloom.queries.{name}").SQL
    return out

"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(rows: DataFrame, array: Column, *keep: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """Elements with their places.

    A plain explode makes Catalyst infer a filter on the array's size, which is pushed down with the whole expression in it; for an ordered fold that
    doubles the work at every level. The outer form has no such filter, and empty arrays are dropped behind it.
    """
    return rows.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())

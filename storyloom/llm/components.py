"""Connected components by alternating large-star and small-star steps over tables in the shared folder.

Edges go from a larger to a smaller node. The large star of an edge's smaller end is read from a table of each node's smallest
neighbour, so that the join is one between two tables, which Spark splits where a node has very many edges. A
round's tables are deleted once the next round is written; where all edges are stars already, no further round is.
A round's tasks follow the number of its edges, which is known, and not the session's shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from storyloom.llm.runtime import counted, few, new_path, remove, write_table


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them; ``n``: edges at most."""
    least = few(edges.groupBy("u").agg(F.min("v").alias("m")), n)
    joined = few(edges.join(least, "u"), n)
    return few(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), 2 * n)


def _large_star(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself; ``least``: (x, m), the smallest neighbour of nodes that have a smaller one. Equal edges fall together in the small star."""
    return few(edges.join(least, edges["v"] == least["x"], "left").select("u", F.coalesce("m", "v").alias("v")), n)


def _written(edges: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their number and a sum of their hashes, taken while they are written."""
    seen = Observation()
    table = write_table(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges", path)
    return table, (seen.get["n"], seen.get["h"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node. Loops and nulls are ignored. ``rows``: the number of edges at most, where known."""
    spark = edges.sparkSession
    path = new_path(spark, "edges")
    first = edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    cur, mark = _written(first if rows is None else few(first, rows), path)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        side, after = new_path(spark, "least"), new_path(spark, "edges")
        least, nodes = counted(few(cur.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")), mark[0]), "least", side)
        if nodes == mark[0] and cur.join(least, cur["v"] == least["x"], "left_semi").isEmpty():
            remove(spark, side)
            break  # every node has one edge, to a node that has none: these are stars
        nxt, now = _written(_small_star(_large_star(cur, least, mark[0]), mark[0]), after)
        remove(spark, side)
        if now == mark:
            remove(spark, after)
            break
        remove(spark, path)
        cur, path, mark = nxt, after, now
    else:
        raise RuntimeError("components did not settle")
    ends = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return few(ends, 2 * mark[0])

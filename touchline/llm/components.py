"""Connected components of an edge table, by alternating star contraction.

Each round links all larger neighbours of a node to its smallest neighbour
(large star), then all smaller neighbours and the node itself (small star).
When nothing changes, every node points straight at the smallest node of its
component. Minima are pre-aggregated before the shuffle, and each round is
written to the shared folder, so no lineage grows and nothing but the two
counters that decide on another round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """edges (a, b), a > b, one row each."""
    if larger:
        near = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges
    least = near.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("n"), F.least("a", "low").alias("m"))
    linked = near.join(least, F.col("a") == F.col("n"))
    if larger:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the least node.

    Self-loops and repeated edges are harmless. An empty table gives an empty
    result; each component's least node itself is not listed.
    """
    now = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                                   F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
    seen = mark(now)
    if seen[0] == 0:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        now = written(_star(_star(now, True), False), "stars")
        got = mark(now)
        if got == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = got
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

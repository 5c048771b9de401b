"""Connected components of a very large identifier graph.

Large-star / small-star contraction (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014): every round is
a minimum per node and a join back, the number of edges never grows, and a logarithmic number of rounds suffices. Nodes
are longs; a component is named by its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.plans.skew import MIN_HOT_ROWS, with_minimum
from kinweave.plans.storage import materialize


def hub_edges(identifiers: DataFrame, key: list[str], node: str, min_hot_rows: int = MIN_HOT_ROWS,
              rows: int | None = None) -> DataFrame:
    """Edges (u, v), u > v, from each node to the smallest node sharing its key: one edge per row, never pairs.

    ``rows``: an upper bound of the table's size when known.
    """
    rows = identifiers.count() if rows is None else rows
    joined = with_minimum(identifiers, key, {"v": F.col(node)}, rows, min_hot_rows)
    return joined.where(F.col(node) > F.col("v")).withColumnRenamed(node, "u")


def _large_star(edges: DataFrame, rows: int, min_hot_rows: int) -> DataFrame:
    """Every neighbour above a node moves to the smallest node at or next to it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = with_minimum(both, "u", {"m": F.least("u", "v")}, 2 * rows, min_hot_rows)
    return least.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, rows: int, min_hot_rows: int) -> DataFrame:
    """Every neighbour below a node, and the node itself, moves to the smallest of them."""
    least = with_minimum(edges, "u", {"m": F.col("v")}, rows, min_hot_rows)
    moved = F.array_distinct(F.array(F.struct(F.greatest("u", "m").alias("u"), F.col("m").alias("v")),
                                     F.struct(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))))
    return least.select(F.explode(moved).alias("e")).select("e.*").where("u > v").distinct()


def _is_done(edges: DataFrame) -> bool:
    """True when every component is a star around its smallest node."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("hub")).union(
        edges.select(F.col("v").alias("n"), F.lit(0), F.lit(1)))
    per_node = ends.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("hub").alias("hub"))
    return per_node.where("leaf > 1 or (leaf = 1 and hub = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 100, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(node, root) for every node that is not the smallest of its component; lone nodes do not appear."""
    current = materialize(edges.select("u", "v").where("u > v").distinct())
    for _ in range(max_rounds):
        large = materialize(_large_star(current, current.count(), min_hot_rows))
        current = materialize(_small_star(large, large.count(), min_hot_rows))
        if _is_done(current):
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import cut_lineage, cut_lineage_counted


def _jump(hooks: DataFrame, max_rounds: int) -> DataFrame:
    """``hooks`` (node, to) followed to their ends by pointer doubling; ``to`` < node throughout."""
    for _ in range(max_rounds):
        ahead = hooks.select(F.col("node").alias("mid"), F.col("to").alias("end"))
        step = hooks.join(ahead, hooks["to"] == ahead["mid"], "left")
        moved = step.where(F.col("end").isNotNull())
        if moved.isEmpty():
            return hooks
        hooks = cut_lineage(step.select("node", F.coalesce("end", "to").alias("to")))
    raise RuntimeError("pointer doubling did not settle")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100
                         ) -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest node it is connected to.

    Each round hooks every node to its smallest smaller neighbour, follows the hooks to their ends by
    pointer doubling and contracts the edges, so that the remaining graph shrinks by a factor
    and rounds grow with the logarithm of its size, not with its diameter. Minima are combined
    map-side; edges lose loops and repeats as they are contracted. Rows with a NULL end are
    ignored; a loop (a = b) only names its node.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    label = cut_lineage(nodes.withColumn("component", F.col("node")))
    live, n = cut_lineage_counted(pairs.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if n == 0:
            return label
        # a < b on every edge: the hooks of b are its smaller neighbours
        hooks = cut_lineage(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")))
        hooks = _jump(hooks, max_rounds)

        def root(df: DataFrame, col: str) -> DataFrame:
            h = hooks.select(F.col("node").alias("_h"), F.col("to").alias("_t"))
            return (df.join(h, df[col] == h["_h"], "left")
                    .withColumn(col, F.coalesce("_t", col)).drop("_h", "_t"))

        label = cut_lineage(root(label, "component"))
        live, n = cut_lineage_counted(root(root(live, "a"), "b").where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def bipartite_components(df: DataFrame, left: str, right: str) -> int:
    """Number of connected components of the graph whose nodes are the values of two columns and
    whose edges are the pairs that occur together. The pairs are a partial aggregate."""
    side = lambda tag, c: F.struct(F.lit(tag).alias("side"), F.col(c).cast("string").alias("v"))
    pairs = df.select(left, right).dropna().distinct()
    found = connected_components(pairs.select(side(0, left).alias("a"), side(1, right).alias("b")))
    return found.select("component").distinct().count()

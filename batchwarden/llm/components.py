"""Connected components of a graph too large for any one machine.

Each round hooks every node to its smallest neighbour, follows those hooks to their roots by pointer
doubling, and contracts the graph to the roots. A hooked tree has at least two nodes, so a round at
least halves the nodes that still have edges. Minima are combined before each shuffle, edges are
distinct pairs, and each step is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from batchwarden.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """From edges (``src``, ``dst``: long) the smallest reachable node per node: (``node``, ``component``).

    Direction, repeats and loops do not matter; nodes without an edge to another node are left out.
    No edges give no rows.
    """
    edges = stage(_undirected(edges), "edges")
    found = None
    while not edges.isEmpty():
        roots = _roots(edges)
        found = roots if found is None else _compose(found, roots)
        found = stage(found, "found")
        left = edges.join(roots.select(F.col("node").alias("src"), F.col("root").alias("a")), "src")
        both = left.join(roots.select(F.col("node").alias("dst"), F.col("root").alias("b")), "dst")
        edges = stage(_undirected(both.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "edges")
    if found is None:
        spark = edges.sparkSession
        return spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    return found.select("node", F.col("root").alias("component"))


def _undirected(edges: DataFrame) -> DataFrame:
    """Distinct edges between different nodes, smaller end first."""
    ends = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return ends.filter("src < dst").distinct()


def _roots(edges: DataFrame) -> DataFrame:
    """The root of every node once each is hooked to its smallest neighbour, if smaller than itself."""
    ends = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    hooks = ends.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("next"))
    hooks = stage(hooks.select("node", F.least("node", "next").alias("root")), "hooks")
    while True:
        further = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = stage(hooks.join(further.filter("root != further"), "root", "left"), "hooks")
        if jumped.filter("further IS NOT NULL").isEmpty():
            return hooks
        hooks = jumped.select("node", F.coalesce("further", "root").alias("root"))


def _compose(found: DataFrame, roots: DataFrame) -> DataFrame:
    """Earlier roots followed to the roots of this round."""
    further = roots.select(F.col("node").alias("root"), F.col("root").alias("further"))
    return found.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))

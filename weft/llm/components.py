"""Connected components of a table of edges by repeated contraction; nothing but row counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import drop, staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of an edge; comp is one node of the component. In each round every
    vertex moves to its least neighbour's least neighbour's ..., two jumps; edges are rewritten and those
    within a vertex fall away, so the vertices at least halve."""
    live = staged(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges")
    comp = None
    while not live.isEmpty():
        used, before = [live], comp
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = staged(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("up")), "parents")
        for _ in range(2):
            jump = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            used.append(parent)
            parent = staged(parent.join(jump, "up").select("node", F.col("top").alias("up")), "parents")
        if comp is None:
            comp = parent.select("node", F.col("up").alias("comp"))
        else:
            comp = comp.join(parent.select(F.col("node").alias("comp"), "up"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
        comp = staged(comp, "components")
        ends = live.join(parent.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(parent.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        live = staged(ends.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).filter("a <> b").distinct(), "edges")
        drop(*used, parent, before)
    return comp if comp is not None else live.select(F.col("a").alias("node"), F.col("b").alias("comp"))

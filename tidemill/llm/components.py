"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its smallest node.

    Every round moves each node to the neighbour (or itself) that comes first
    in a random order drawn for the round, and contracts the edges, so that
    chains and stars alike shrink by a constant factor.  Each round is written
    to the shared folder; nodes and edges never reach the driver.  Self loops
    and repeated edges do no harm, edges with a null end are left out.
    """
    edges = cut_lineage(edges.select("u", "v").where("u <> v").distinct(), "edges")
    both = edges.select("u").union(edges.select("v")).distinct()
    labels = both.select(F.col("u").alias("node"), F.col("u").alias("label"))
    for turn in range(200):
        if edges.isEmpty():
            break
        order = lambda node: F.xxhash64(F.lit(turn), node)
        around = edges.select(F.explode(F.array(
            F.struct(F.col("u").alias("node"), F.col("u").alias("to")),
            F.struct(F.col("u").alias("node"), F.col("v").alias("to")),
            F.struct(F.col("v").alias("node"), F.col("v").alias("to")),
            F.struct(F.col("v").alias("node"), F.col("u").alias("to")),
        )).alias("e")).select("e.*")
        moves = cut_lineage(
            around.groupBy("node").agg(F.min(F.struct(order(F.col("to")).alias("h"), F.col("to"))).alias("m")).select("node", F.col("m.to").alias("to")),
            "moves",
        )
        contracted = (
            edges.join(moves.select(F.col("node").alias("u"), F.col("to").alias("a")), "u")
            .join(moves.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
            .where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct()
        )
        edges = cut_lineage(contracted, "edges")
        labels = cut_lineage(
            labels.join(moves.select(F.col("node").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels"
        )
    else:
        raise RuntimeError("the components did not settle")
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")

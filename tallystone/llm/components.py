"""Connected components of a link table, by contraction.

In each round every node points at the neighbour (or itself) of lowest random rank, and the
links between the nodes pointed at are the next, much smaller graph. Random ranks keep a
long chain from shrinking one node at a time. Only minima are taken per node, so a node with
very many links needs no gathering. Every round's table is written to the shared folder.
"""

from pyspark.sql import functions as F

from .common import materialize


def connected(edges):
    """(node, component) for every node of the links (a, b); components are named by a node."""
    edges = materialize(edges.select("a", "b").filter("a <> b"), "links")
    rounds = []
    while not edges.isEmpty():
        seed = F.lit(len(rounds))

        def ranked(c):
            return F.struct(F.xxhash64(F.col(c), seed).alias("rank"), F.col(c).alias("node"))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(ranked("b")).alias("near"))
        points = materialize(lowest.select(
            F.col("a").alias("node"),
            F.least(F.col("near"), ranked("a"))["node"].alias("to")), "points")
        rounds.append(points)
        at_a = points.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        at_b = points.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(at_a, "a").join(at_b, "b")
        low, high = F.least("to_a", "to_b"), F.greatest("to_a", "to_b")
        edges = materialize(moved.filter("to_a <> to_b").select(
            low.alias("a"), high.alias("b")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    final = rounds[-1].withColumnRenamed("to", "component")
    for points in reversed(rounds[:-1]):
        ends = final.select(F.col("node").alias("to"), "component")
        final = points.join(ends, "to", "left").select(
            "node", F.coalesce("component", "to").alias("component"))
    return final

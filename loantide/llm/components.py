"""Connected components of a large graph by contraction; nothing is gathered on the driver or in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_anew, written


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of ``edges`` (columns a and b, long); null ends are no edge.

    In each round every node points to its neighbour of least hash, pointers are doubled once, and the edges are contracted
    along them; hashes keep sorted chains from taking one round a node. Rounds are written to the shared folder, so they are
    not computed again; their number is logarithmic in the longest chain. Repeated edges and loops are allowed.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        least = both.groupBy("node").agg(F.min(order("to")).alias("to"))
        once = written(least.select("node", F.least(F.col("to"), order("node"))["id"].alias("to")), "pointers")
        again = once.select(F.col("node").alias("to"), F.col("to").alias("next"))
        steps.append(written(once.join(again, "to").select("node", F.col("next").alias("to")), "pointers"))
        ends = steps[-1]
        for end in ("a", "b"):
            edges = edges.join(ends.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to")), end).drop(end).withColumnRenamed(f"{end}_to", end)
        edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    found = nodes.withColumn("root", F.col("node"))
    for step in steps:
        moved = step.select(F.col("node").alias("root"), "to")
        found = found.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    found = written(found, "roots")
    names = found.groupBy("root").agg(F.min("node").alias("component"))
    return joined_anew(found, names, "root").select("node", "component")

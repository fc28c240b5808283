"""Connected components of a graph given as edges, without a task or the driver holding one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwarden.llm.rows import join_side, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the edges (a, b); a component is its smallest node.

    In each round every node joins its neighbour, or itself, that comes first by a hash of
    the node, and joined nodes become one. A hash keeps chains from being long, so that a
    constant share of the nodes goes in a round on average, and a star goes in two or three.
    Rounds end when no edge is left; each one's edges are stored. Nulls join nothing.
    """
    left = stored(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges"
    )
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    found = nodes.withColumn("at", F.col("node"))
    # An edge has two nodes, so no table of a round has more rows than twice its edges.
    all_edges = edges_left = left.count()
    while edges_left:
        both = left.union(left.select("b", "a"))
        rank = F.struct(F.xxhash64(F.col("b")).alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64(F.col("a")).alias("h"), F.col("a").alias("to"))
        joined = stored(
            both.groupBy("a").agg(F.min(rank).alias("m")).select("a", F.least("m", own)["to"].alias("to")),
            "joined",
        )
        to_a = join_side(joined.select("a", F.col("to").alias("_a")), 2 * edges_left)
        to_b = join_side(joined.select(F.col("a").alias("b"), F.col("to").alias("_b")), 2 * edges_left)
        left = stored(
            left.join(to_a, "a")
            .join(to_b, "b")
            .where("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
            .distinct(),
            "edges",
        )
        step = join_side(joined.select(F.col("a").alias("at"), F.col("to").alias("_to")), 2 * edges_left)
        found = found.join(step, "at", "left").select("node", F.coalesce("_to", "at").alias("at"))
        edges_left = left.count()
    found = stored(found, "roots")
    smallest = found.groupBy("at").agg(F.min("node").alias("component"))
    return stored(found.join(join_side(smallest, 2 * all_edges), "at").select("node", "component"), "components")

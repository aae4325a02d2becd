"""Connected components of a distributed edge list."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closepass.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the least node of its component."""
    found = stars(edges)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots: root is the least node of its component.

    Alternating star steps: each node's larger neighbours are linked to its least neighbour, then its
    smaller ones, until every component is a star around its least node.  Edges stay in Spark; only whether
    that holds reaches the driver.  A node that many edges share is pre-aggregated before each shuffle.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs)
    while not _are_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        pairs = stored(small.select("e.a", "e.b").where("a <> b").distinct())
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _are_stars(pairs: DataFrame) -> bool:
    """Whether each larger end `a` of the distinct `pairs` has one edge and is no edge's smaller end."""
    ends = pairs.select("a", F.lit(1).alias("up")).unionByName(pairs.select(F.col("b").alias("a"), F.lit(0).alias("up")))
    nodes = ends.groupBy("a").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.where("up > 1 OR (up = 1 AND least = 0)").isEmpty()

"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import sorted_side, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(sorted_side(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these neighbours. Takes edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(sorted_side(least), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges`` (columns a, b of one type) with the least node that it reaches.

    Large-star and small-star rounds alternate until nothing moves; each round is two shuffles and a
    table in the shared folder. Only a checksum of the edges reaches the driver. Rows with a null end
    and loops are left out; repeated edges count once. Returns (node, root), without nodes that have
    no edge; an empty input gives no rows. Raises if ``max_rounds`` rounds don't settle it.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = written(now, "edges"), None
    for _ in range(max_rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(seen)
        now = written(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components are not settled after {max_rounds} rounds")

"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.llm.common import discard, stored


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` of the nodes in ``edges`` (``a``, ``b``: any ordered type).

    ``component`` is the least node reachable. Edges with a null end count for nothing; an
    edge from a node to itself only makes the node known. Every round aggregates minima
    (with a map-side part) and joins on them, so that a node with very many neighbours
    reaches no single task unsplit. Rounds grow with the logarithm of the longest path and
    are written to the shared folder.
    """
    clean = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct()
    clean = stored(clean, "edges")
    nodes = clean.select(F.col("a").alias("node")).union(clean.select("b")).distinct()
    star, seen = clean.where("a <> b"), None
    while True:
        last, star = star, stored(_small_star(_large_star(star)), "stars")
        now = _fingerprint(star)
        if seen is not None:
            discard(last)
        if now == seen or now[0] == 0:
            break
        seen = now
    found = star.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )

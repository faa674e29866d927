"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranktide.session import freeze


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    return row[0], row[1]


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``links`` (a, b: longs).

    A round ties every node's larger neighbours to its smallest neighbour, then every node and its smaller neighbours to
    the smallest of them; the number of rounds grows with the logarithm of the longest path. Neighbours are reduced to
    their minimum by partial aggregation and joined back, so no neighbourhood is ever gathered. Every round is written
    to the shared folder, which cuts the lineage and lets a lost executor's work be read again.
    """
    edges = freeze(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _fingerprint(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(lowest, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = freeze(tied.union(lowest.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    # Now every edge leads from a node to the smallest of its component.
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )

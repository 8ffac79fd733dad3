"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .base import written

MOST_ROUNDS = 60
FILE_EDGES = 1 << 20


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them; ``a`` is the larger end.

    One exchange by the node does for the repeats, the minimum and the join.
    """
    down = edges.repartition("a").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    # The least neighbour's own row gives the node's link.
    return down.join(least, "a").select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b"))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _round(edges: DataFrame) -> DataFrame:
    return _clean(_small(_large(edges).where("a <> b")))


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, with their number and a sum of their hashes that the writing tasks take."""
    seen = Observation()
    mark = (F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("mark"))
    kept = written(edges.observe(seen, *mark), "links")
    # An empty table may be left without figures.
    found = dict(seen.get)
    return kept, (found.get("n", 0), found.get("mark", 0))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``least`` (the smallest node it reaches) for every node of the links ``a``, ``b``.

    Each round is written to the shared folder, in files of ``FILE_EDGES`` links, so a lost
    executor costs one round; the rounds needed grow with the logarithm of the longest path.
    """
    edges, mark = _kept(_clean(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        # Few links are not written to a file for each shuffle partition.
        edges, now = _kept(_round(edges).coalesce(1 + 2 * mark[0] // FILE_EDGES))
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"links are not resolved after {MOST_ROUNDS} rounds")
    # Stars: every node but a centre has one link, to its centre.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("least")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct()
    )

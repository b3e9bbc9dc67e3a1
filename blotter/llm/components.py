"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.sources import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (columns a, b; whole numbers).

    The root is the smallest node of the component and has a row, too. Two steps take turns:
    each node hands its larger neighbours to its smallest one, then each node and its
    smaller neighbours are hung below the smallest. The rounds needed grow with the logarithm
    of the longest path. Every round is written to a shared table, so a lost executor costs
    a round at most. Minima are taken in the map tasks first; the join that follows may
    be split by adaptive execution where a node has very many neighbours.
    """
    edges = stored(_clean(links.select("a", "b")), "links")
    state = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _clean(edges: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _clean(both.join(least, "a").where(F.col("b") > F.col("a")).select("b", F.col("m").alias("a")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _clean(hung.unionByName(least.select("a", F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    """Tells two link tables apart: their number and a sum over them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

"""Connected components of links by alternating large and small stars.

Both steps only need the smallest neighbour of each vertex, an aggregate with map-side combining, joined back to the
links; the number of rounds grows with the logarithm of the longest path. Links never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Connects each vertex's larger neighbours to the smallest of its neighbourhood."""
    near = _both(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connects each vertex and its smaller neighbours to the smallest of those."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _sums(links: DataFrame) -> tuple:
    """Number and hash sum of links: equal sums mean that a round has changed nothing."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links, b smaller than a or not, to (a, b) with b the smallest vertex that a reaches; such b aren't listed as a.

    Links of a vertex to itself and rows with a null count for nothing.
    """
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _sums(now)
    while state[0]:
        after = materialize(_small_star(_large_star(now)), "links")
        sums = _sums(after)
        drop_table(now)
        now = after
        if sums == state:
            return now
        state = sums
    return now

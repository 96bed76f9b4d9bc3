"""Fusing rankings: reciprocal ranks and weighted, min-max-normalised scores. Rankings meet in one shuffle on (query, id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK_OFFSET = 60


def reciprocal_ranks(rankings: list[tuple[DataFrame, float]], query_col: str, id_col: str) -> DataFrame:
    """(query, id, score): the sum over rankings of weight / (60 + rank)."""
    parts = [r.select(query_col, id_col, (F.lit(w) / (RANK_OFFSET + F.col("rank"))).alias("s")) for r, w in rankings]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(query_col, id_col).agg(F.sum("s").alias("score"))


def min_max(scored: DataFrame, query_col: str, score_col: str = "score", out: str = "norm") -> DataFrame:
    """Scores scaled to 0..1 over a query's candidates; all equal gives 1."""
    w = Window.partitionBy(query_col)
    low, high = F.min(score_col).over(w), F.max(score_col).over(w)
    return scored.withColumn(out, F.when(high == low, 1.0).otherwise((F.col(score_col) - low) / (high - low)))


def weighted(dense: DataFrame, lexical: DataFrame, alpha: float, query_col: str, id_col: str) -> DataFrame:
    """(query, id, score): alpha * normalised dense + (1 - alpha) * normalised lexical; what a side lacks counts 0."""
    d = min_max(dense, query_col).select(query_col, id_col, F.col("norm").alias("d"))
    x = min_max(lexical, query_col).select(query_col, id_col, F.col("norm").alias("x"))
    score = alpha * F.coalesce("d", F.lit(0.0)) + (1 - alpha) * F.coalesce("x", F.lit(0.0))
    return d.join(x, [query_col, id_col], "full").select(query_col, id_col, score.alias("score"))

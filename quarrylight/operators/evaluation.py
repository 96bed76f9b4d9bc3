"""Retrieval evaluation: recall, reciprocal ranks, term hits and experiment matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def source_ranks(hits: DataFrame, gold: DataFrame, query_col: str, source_col: str, rank_col: str = "rank") -> DataFrame:
    """(query, found, reciprocal): for each query with a gold source (query, gold), the first hit from it."""
    first = gold.join(hits, (gold[query_col] == hits[query_col]) & (gold["gold"] == hits[source_col]), "left").groupBy(gold[query_col]).agg(F.min(rank_col).alias("first"))
    return first.select(query_col, F.col("first").isNotNull().alias("found"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("reciprocal"))


def summary(ranks: DataFrame, by: list[str]) -> DataFrame:
    return ranks.groupBy(*by).agg(F.count("*").alias("cases"), F.round(F.avg(F.col("found").cast("double")), 6).alias("recall"), F.round(F.avg("reciprocal"), 6).alias("mrr"))


def term_hits(hits: DataFrame, terms: DataFrame, query_col: str = "item_id", id_col: str = "doc_id") -> DataFrame:
    """(query, hit): whether one single hit has all the query's terms. hits: (query, id, tokens); terms: distinct (query, term)."""
    need = terms.groupBy(query_col).agg(F.count("*").alias("need"))
    have = hits.select(query_col, id_col, F.explode(F.array_distinct("tokens")).alias("term")).join(terms, [query_col, "term"]).groupBy(query_col, id_col).agg(F.count("*").alias("have"))
    best = have.groupBy(query_col).agg(F.max("have").alias("best"))
    return need.join(best, query_col, "left").select(query_col, F.coalesce(F.col("best") == F.col("need"), F.lit(False)).alias("hit"))


def source_hits(hits: DataFrame, gold: DataFrame, query_col: str, source_col: str) -> DataFrame:
    """(query, hit): whether one hit's source ends with the expected one; a case that expects none counts as hit. gold: (query, gold)."""
    ends = F.coalesce(F.endswith(hits[source_col], gold["gold"]), F.lit(False))
    rows = gold.join(hits, gold[query_col] == hits[query_col], "left").groupBy(gold[query_col], gold["gold"]).agg(F.bool_or(ends).alias("__any"))
    return rows.select(query_col, ((F.coalesce("gold", F.lit("")) == "") | F.col("__any")).alias("hit"))


def evidence_ranks(hits: DataFrame, gold: DataFrame, terms: DataFrame, query_col: str = "item_id", source_col: str = "source") -> DataFrame:
    """(query, found, reciprocal, evidence): as source_ranks, and whether the hits of the expected source have all terms together.

    hits: (query, source, rank, tokens); gold: (query, gold); terms: distinct (query, term).
    """
    ranks = source_ranks(hits, gold, query_col, source_col)
    right = hits.join(gold, query_col).where(F.col(source_col) == F.col("gold"))
    have = right.select(query_col, F.explode(F.array_distinct("tokens")).alias("term")).distinct().join(terms, [query_col, "term"]).groupBy(query_col).agg(F.count("*").alias("have"))
    need = terms.groupBy(query_col).agg(F.count("*").alias("need"))
    rows = ranks.join(need, query_col, "left").join(have, query_col, "left")
    return rows.select(query_col, "found", "reciprocal", (F.col("found") & (F.coalesce("have", F.lit(0)) == F.coalesce("need", F.lit(0)))).alias("evidence"))


def history(turns: DataFrame, last: int = 9, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """The last turns of each conversation, in order: (conv, n, roles, chars)."""
    w = Window.partitionBy(conv_col).orderBy(F.col(turn_col).desc(), "role", "text")
    kept = turns.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= last)
    rows = kept.groupBy(conv_col).agg(F.sort_array(F.collect_list(F.struct(turn_col, "role", "text"))).alias("rows"))
    return rows.select(conv_col, F.size("rows").cast("long").alias("n"), F.array_join(F.transform("rows", lambda r: r["role"]), ",").alias("roles"), F.aggregate("rows", F.lit(0).cast("long"), lambda s, r: s + F.length(r["text"])).alias("chars"))

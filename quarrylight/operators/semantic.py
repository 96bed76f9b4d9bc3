"""Semantic chunks: a text's sentences, cut where neighbouring sentences are least alike.

Sentences of a text stay in its row: only their similarities are made in Python, cuts and chunks are array functions, and
nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.text import sentences
from quarrylight.operators.embedding import Embedder, neighbour_similarity

#: Places to which similarities are rounded before they are compared.
PLACES = 9


def percentile(values: Column, share: float) -> Column:
    """The value of an array at a share of its order, between neighbours in proportion; null of an empty one."""
    ordered = F.sort_array(values)
    at = F.lit(float(share)) * (F.size(values) - 1)
    low = F.get(ordered, F.floor(at).cast("int"))
    return low + (F.get(ordered, F.ceil(at).cast("int")) - low) * (at - F.floor(at))


def cut_places(similar: Column, n: Column, cut: Column, longest: int) -> Column:
    """(start, size) of the pieces of n members: one ends where the similarity to the next falls under the cut, or at ``longest`` members."""
    last = F.sequence(F.lit(0), n - 1)
    ends = lambda s, c: F.filter(last, lambda i: (i == n - 1) | (F.round(F.get(s, i), PLACES) < F.round(c, PLACES)))
    runs = lambda e: F.transform(e, lambda to, k: F.struct(F.when(k == 0, 0).otherwise(F.get(e, k - 1) + 1).alias("from"), to.alias("to")))
    pieces = lambda r: F.transform(F.sequence(r["from"], r["to"], F.lit(longest)), lambda s: F.struct(s.alias("start"), (F.least(s + longest - 1, r["to"]) - s + 1).alias("size")))
    # F.transform over one-element arrays names a value once, so that it is made once
    return F.flatten(F.flatten(F.transform(F.array(ends(similar, cut)), lambda e: F.transform(runs(e), pieces))))


def chunks(docs: DataFrame, embedder: Embedder, share: float | None = 0.3, threshold: float | None = None, longest: int = 10, text_col: str = "text") -> DataFrame:
    """Columns of docs but the text, and (chunk, n_sentences, text), a row for each chunk.

    A threshold, if given, takes the place of the percentile of the text's own similarities. Sentences are joined without
    a blank. Null and blank texts have no chunks, a text of one sentence is one chunk.
    """
    if longest < 1 or (threshold is None and not 0 <= (share if share is not None else 0.3) <= 1):
        raise ValueError("longest must be at least 1 and share between 0 and 1")
    kept = [c for c in docs.columns if c != text_col]
    split = docs.select(*kept, sentences(F.col(text_col)).alias("__s"))
    alike = split.withColumn("__sim", neighbour_similarity(F.col("__s"), embedder))
    cut = F.lit(float(threshold)) if threshold is not None else percentile(F.col("__sim"), 0.3 if share is None else share)
    told = F.array(F.struct(F.col("__sim").alias("sim"), F.size("__s").alias("n"), cut.alias("cut")))  # named in a lambda, or the cut would be made for each sentence
    places = F.flatten(F.transform(told, lambda v: F.when(v["n"] > 0, cut_places(v["sim"], v["n"], v["cut"], longest))))
    each = alike.select(*kept, "__s", F.posexplode_outer(places).alias("chunk", "__p")).where("chunk is not null")  # outer: else a filter for empty arrays makes them once more
    return each.select(*kept, "chunk", F.col("__p.size").alias("n_sentences"), F.array_join(F.slice("__s", F.col("__p.start") + 1, F.col("__p.size")), "").alias("text"))

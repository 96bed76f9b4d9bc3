"""Approximate nearest vectors: an inverted-file index over all rows, with exact cosines of what it looks at.

Centroids are fitted on a bounded sample on the driver (at most SAMPLE vectors, chosen by hash of the id); every vector is
put into the list of its nearest centroid, wherever it lies. Lists are dealt into blocks of bounded size, so that a list
that holds a third of all rows is many tasks. A query looks at the lists whose centroids are nearest to it; queries meet a
list in blocks too, and a pair of blocks is one matrix product. How many lists a query must look at is measured: exact
neighbours of a bounded sample of queries say in which of its lists they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.jobs.shared import written
from quarrylight.operators import dense

#: Most vectors that centroids are fitted on; most queries whose neighbours are found exactly to choose the number of lists.
SAMPLE, TRIED = 20_000, 200
#: Vectors and queries of a block.
BLOCK, ASKED = 4096, 512


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors; zero vectors stay."""
    x = np.array(column.to_pylist(), np.float64).reshape(len(column), -1 if len(column) else 0)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of vectors with finite components only."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), v.cast("array<double>").alias("v"))


def centroids(rows: DataFrame, lists: int, sample: int = SAMPLE, rounds: int = 12) -> np.ndarray:
    """Directions of at most ``lists`` clusters of a sample of unit vectors; empty clusters take the vector farthest from its own."""
    x = _matrix(rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow().column("v").combine_chunks())
    c = np.unique(x, axis=0)
    c = c[np.random.default_rng(7).permutation(len(c))[:lists]]
    for _ in range(rounds if len(c) else 0):
        near = x @ c.T
        to = near.argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, to, x)
        lonely = np.flatnonzero(np.bincount(to, minlength=len(c)) == 0)
        sums[lonely] = x[np.argsort(near.max(1))[: len(lonely)]]
        c = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-300)
    return c


@dataclass
class Index:
    """Centroids, and blocks (list, block, ids, xs): ids and unit vectors of at most some BLOCK rows of a list."""

    centroids: np.ndarray
    blocks: DataFrame
    probes: int

    def search(self, queries: DataFrame, k: int, probes: int | None = None, query_col: str = "query_id", vector_col: str = "embedding", id_col: str = "vec_id", include_self: bool = False) -> DataFrame:
        """(query, id, cosine, rank) of the k best vectors of the lists that each query looks at, by exact cosine."""
        kinds = [queries.schema[query_col].dataType.simpleString(), dict(self.blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")]
        if not len(self.centroids):  # an index of nothing
            return queries.sparkSession.createDataFrame([], f"`{query_col}` {kinds[0]}, `{id_col}` {kinds[1]}, cosine double, rank int")
        asked = _with_lists(usable(queries, query_col, vector_col), self.centroids, min(probes or self.probes, len(self.centroids)))
        found = _compare(_query_blocks(asked), self.blocks, k, include_self, *kinds)
        order = Window.partitionBy("q").orderBy(F.round("cosine", 6).desc(), "id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select(F.col("q").alias(query_col), F.col("id").alias(id_col), "cosine", "rank")


def _with_lists(rows: DataFrame, c: np.ndarray, n: int) -> DataFrame:
    """(list, place, id, v): a row for each of a vector's n nearest lists; place counts from 0."""
    shared = rows.sparkSession.sparkContext.broadcast(c)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            order = np.argsort(-(x @ shared.value.T), axis=1, kind="stable")[:, :n]
            at = pa.array(np.repeat(np.arange(b.num_rows), order.shape[1]))
            unit = pa.array(list(x), pa.list_(pa.float64())).take(at)
            yield pa.RecordBatch.from_arrays([pa.array(order.ravel()), pa.array(np.tile(np.arange(order.shape[1]), b.num_rows)), b.column(0).take(at), unit], names=["list", "place", "id", "v"])

    return rows.mapInArrow(run, f"list long, place long, id {kind}, v array<double>")


def _dealt(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Blocks of some ``size`` rows of each list: (list, <prefix>block, <prefix>ids, <prefix>xs). A row is dealt by the hash of its id."""
    counts = rows.groupBy("list").agg(F.count("*").alias("__n"))  # one row a list
    dealt = rows.join(F.broadcast(counts), "list").withColumn("__b", F.pmod(F.xxhash64("id"), F.ceil(F.col("__n") / size)))
    return dealt.groupBy("list", F.col("__b").alias(f"{prefix}block")).agg(F.collect_list("id").alias(f"{prefix}ids"), F.collect_list("v").alias(f"{prefix}xs"))


def _query_blocks(asked: DataFrame) -> DataFrame:
    return _dealt(asked, ASKED, "q")


def _compare(queries: DataFrame, blocks: DataFrame, k: int, include_self: bool, kind: str, other: str) -> DataFrame:
    """(q, id, cosine): the k best of each query in each pair of blocks of one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                qi, qx, vi, vx = (c[r].as_py() for c in b.columns)
                cos = np.array(qx, np.float64) @ np.array(vx, np.float64).T
                qi, vi = np.array(qi), np.array(vi)
                if not include_self:
                    cos[qi[:, None] == vi[None]] = -np.inf
                place = np.unique(vi, return_inverse=True)[1]
                order = np.lexsort((np.broadcast_to(place, cos.shape), -np.round(cos, 6)), axis=1)[:, :k]
                best = np.take_along_axis(cos, order, 1)
                keep = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qi, order.shape[1])[keep.ravel()]), pa.array(vi[order][keep]), pa.array(best[keep])], names=["q", "id", "cosine"])

    pairs = blocks.select("list", "ids", "xs").join(queries, "list").select("qids", "qxs", "ids", "xs")
    return pairs.mapInArrow(run, f"q {kind}, id {other}, cosine double")


def build(vectors: DataFrame, lists: int | None = None, k: int = 5, recall: float = 0.95, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> Index:
    """An index over all usable vectors; by default with as many lists as the root of their number, at most 4096.

    ``probes`` is the least number of lists that hold a share ``recall`` of the exact k neighbours of a sample of rows.
    """
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    c = centroids(rows, lists or int(np.clip(np.sqrt(n), 1, 4096)), sample)
    if not len(c):
        return Index(c, rows.sparkSession.createDataFrame([], f"list long, block long, ids array<{dict(rows.dtypes)['id']}>, xs array<array<double>>"), 0)
    put = written(_with_lists(rows, c, 1).select("list", "id", "v"), "index-rows")
    blocks = written(_dealt(put, BLOCK, ""), "index-blocks")
    tried = rows.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(TRIED).select(F.col("id").alias("query_id"), F.col("v").alias("embedding"))
    exact = dense.nearest(tried, rows.select(F.col("id").alias("vec_id"), F.col("v").alias("embedding")), k).select("query_id", F.col("vec_id").alias("id"))
    orders = _with_lists(tried.select(F.col("query_id").alias("id"), F.col("embedding").alias("v")), c, len(c)).select("list", "place", F.col("id").alias("query_id"))
    places = exact.join(put.select("id", "list"), "id").join(orders, ["query_id", "list"]).groupBy("place").agg(F.count("*").alias("c")).orderBy("place").collect()  # a row a list at most
    share = np.cumsum([r.c for r in places]) / max(1, sum(r.c for r in places))
    enough = int(np.searchsorted(share, recall))
    return Index(c, blocks, places[min(enough, len(places) - 1)].place + 1 if places else len(c))


def measured_recall(found: DataFrame, exact: DataFrame, query_col: str = "query_id", id_col: str = "vec_id") -> float:
    """The share of exact neighbours that were found."""
    hit = exact.select(query_col, id_col).join(found.select(query_col, id_col), [query_col, id_col], "left_semi").count()
    return hit / max(1, exact.count())

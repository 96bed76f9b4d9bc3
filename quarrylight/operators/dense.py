"""Dense ranking: exact nearest vectors of a stated query set, by blocks.

Vectors and queries are dealt into blocks of bounded size; each pair of a query block and a vector block is one matrix
product inside a task, which returns its k best for each query. Only those are shuffled to the final ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 2048
#: Most queries that are broadcast to the vectors' blocks; more of them meet the blocks by a shuffle.
BROADCAST_QUERIES = 20_000


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [v.values.to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for v in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], names=["id", "x"])


def _blocks(vectors: DataFrame, id_col: str, vector_col: str, prefix: str) -> tuple[DataFrame, int]:
    """(ids, xs) of each block, a vector's doubles as bytes; and how many vectors there are."""
    count = vectors.count()
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(_as_bytes, f"id {kind}, x binary")
    dealt = rows.withColumn(f"{prefix}b", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-count // BLOCK)))))
    return dealt.groupBy(f"{prefix}b").agg(F.collect_list("id").alias(f"{prefix}ids"), F.collect_list("x").alias(f"{prefix}xs")), count


def nearest(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", query_col: str = "query_id", include_self: bool = False) -> DataFrame:
    """(query, id, cosine, rank) of the k vectors nearest to each query by cosine in double precision."""
    (q, asked), (v, _) = _blocks(queries, query_col, vector_col, "q"), _blocks(vectors, id_col, vector_col, "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unit(raw: list[bytes]) -> np.ndarray:
            x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
            return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)

        for b in batches:
            for r in range(b.num_rows):
                qi, qv, vi, vv = (c[r].as_py() for c in b.columns)
                cos = unit(qv) @ unit(vv).T
                vi = np.array(vi)
                if not include_self:
                    cos[np.array(qi)[:, None] == vi[None]] = -np.inf
                rounded, place = np.round(cos, 6), np.unique(vi, return_inverse=True)[1]  # ids by their order: numbers sort faster than strings
                order = np.lexsort((np.broadcast_to(place, cos.shape), -rounded), axis=1)[:, :k]
                best = np.take_along_axis(cos, order, 1)
                keep = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(qi), order.shape[1])[keep.ravel()]), pa.array(vi[order][keep]), pa.array(best[keep])], names=["q", "id", "cosine"])

    pairs = v.crossJoin(F.broadcast(q) if asked <= BROADCAST_QUERIES else q).select("qids", "qxs", "vids", "vxs")  # blocks, not rows
    kind = vectors.schema[id_col].dataType.simpleString()
    found = pairs.mapInArrow(run, f"q {queries.schema[query_col].dataType.simpleString()}, id {kind}, cosine double")
    order = Window.partitionBy("q").orderBy(F.round("cosine", 6).desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_col), F.col("id").alias(id_col), "cosine", "rank")


def diverse(candidates: DataFrame, vectors: DataFrame, k: int = 4, weight: float = 0.65, id_col: str = "vec_id", vector_col: str = "embedding", query_col: str = "query_id") -> DataFrame:
    """Maximal marginal relevance over each query's candidates (query, id, cosine): greedy choice of k; (query, id, place)."""

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rank"]).reset_index(drop=True)
        x = np.array(rows["v"].tolist(), np.float64)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        sim, gain, chosen = x @ x.T, rows["cosine"].to_numpy(), []
        while len(chosen) < min(k, len(rows)):
            worth = weight * gain - (1 - weight) * (sim[:, chosen].max(1) if chosen else 0)
            worth[chosen] = -np.inf
            chosen.append(int(np.round(worth, 9).argmax()))
        return pd.DataFrame({query_col: rows[query_col].iloc[chosen].to_numpy(), id_col: rows[id_col].iloc[chosen].to_numpy(), "place": range(1, len(chosen) + 1)})

    joined = candidates.join(vectors.select(id_col, F.col(vector_col).cast("array<double>").alias("v")), id_col)
    kinds = [candidates.schema[c].dataType.simpleString() for c in (query_col, id_col)]
    return joined.groupBy(query_col).applyInPandas(choose, f"{query_col} {kinds[0]}, {id_col} {kinds[1]}, place int")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Of two double arrays."""
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))

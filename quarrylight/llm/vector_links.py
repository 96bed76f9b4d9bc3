"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c). Vectors are projected on leading principal dimensions
(which can only shorten distances), sorted by grid cells of side epsilon there, and cut into blocks of the sequence.
Intervals of the sequence are joined recursively: pairs of long intervals first, then the pairs of their parts, and
only pairs whose bounding boxes come within epsilon go on. Pairs of blocks that are left are dealt to tasks as tiles of
the pair grid, so that a block travels once a tile, and compared in double precision there; a task returns for each
vector its number of links and one link into its local component; links of a pair of blocks are never listed.

Vectors that are equal (and of one label) are one vertex with a multiplicity from the start, named by a 128-bit digest
of label and components; only digests are grouped and joined, vectors travel as bytes and only to the comparison.
Principal dimensions are fitted on at most ``sample`` vertices chosen by hash; they steer the pruning only, never the
result.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, vectors whose label or id is
null, and vectors of different dimension link with nothing (0 links; the component is the own id); rows that repeat
count as vectors of their own, also where an id repeats with another vector or label: each row has the links and the
component of its own vector; an empty table gives an empty result; input columns besides the three named are neither
read nor returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, spread_join, text_batches
from .components import components

SAMPLE = 4096
BLOCK = 1024
DIMENSIONS = 6
#: Bits for the number of a block in its partition: more than a partition can hold rows.
WITHIN = 32
#: Bits of a block's number in the sequence that each level of the recursion drops: intervals of partitions, partitions, intervals of blocks, blocks.
LEVELS = (50, 44, 38, 32, 12, 6, 0)
#: Bits of the side of a tile: 8 x 8 block pairs go to one task.
TILE = 3


def principal(sample: list[np.ndarray], dimensions: int) -> np.ndarray:
    """Leading principal directions (columns) of the unit vectors of the commonest length."""
    if not sample:
        return np.zeros((0, 0))
    sizes = np.array([len(v) for v in sample])
    size = np.bincount(sizes).argmax()
    x = np.array([v for v in sample if len(v) == size], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(size))
    return np.atleast_2d(vectors)[:, ::-1][:, :dimensions]


def named_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, cid, x) of every row: x the doubles as bytes, cid the vertex; label to x are null where a row can't link."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    square = F.aggregate(v.cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
    usable = v.isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & finite & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(usable & square.between(1e-290, 1e290), F.lit(False))
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.when(usable, F.col(label_col).cast("string")).alias("label"), F.when(usable, v.cast("array<double>")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            dims, cids, raws = [], [], []
            for label, v in zip(b.column(1).to_pylist(), b.column(2)):
                x = None if label is None else (v.values.to_numpy(zero_copy_only=False) + 0.0).tobytes()  # no negative zeros
                raws.append(x)
                dims.append(None if x is None else len(x) // 8)
                cids.append(None if x is None else hashlib.blake2b(label.encode("utf-8", "surrogatepass") + b"\0" + x, digest_size=16).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(cids, pa.string()), pa.array(raws, pa.binary())], names=["id", "label", "dim", "cid", "x"])

    return rows.mapInArrow(run, f"id {kind}, label string, dim int, cid string, x binary")


def sequence_blocks(points: DataFrame, axes: np.ndarray, epsilon: float, block: int) -> DataFrame:
    """(block, label, dim, lo, hi, cids, ms, x): blocks of the grid order; x holds the vertices' doubles, row by row."""
    k = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            sizes = b.column(2).to_numpy()
            p = np.zeros((b.num_rows, k))
            fit = np.flatnonzero(sizes == axes.shape[0]) if k else []
            if len(fit):
                x = np.frombuffer(b"".join(b.column(3).take(pa.array(fit)).to_pylist()), np.float64).reshape(len(fit), -1)
                p[fit] = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ axes
            cells = np.floor(p / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(cells), pa.list_(pa.int32())), pa.array(list(p), pa.list_(pa.float64()))], names=["cid", "label", "dim", "x", "m", "cell", "p"])

    placed = points.select("cid", "label", "dim", "x", "m").mapInArrow(project, "cid string, label string, dim int, x binary, m long, cell array<int>, p array<double>")
    placed = materialize(placed, "placed")
    n = placed.count()
    order = [F.col("label"), F.col("dim"), F.col("cell"), F.col("cid")]
    ranged = placed.repartitionByRange(max(1, -(-n // (8 * block))), *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << WITHIN, 0
        carry = None

        def emit(rows: pa.Table, number: int) -> pa.RecordBatch:
            p = rows.column("p").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, k)
            lo, hi = p.min(0), p.max(0)
            x = b"".join(rows.column("x").to_pylist())
            one = lambda c: rows.column(c).slice(0, 1).combine_chunks()
            wide = lambda c, kind: pa.array([rows.column(c).to_pylist()], kind)
            return pa.RecordBatch.from_arrays([pa.array([base + number], pa.int64()), one("label"), one("dim"), pa.array([lo], pa.list_(pa.float64())), pa.array([hi], pa.list_(pa.float64())), wide("cid", pa.list_(pa.string())), wide("m", pa.list_(pa.int64())), pa.array([x], pa.binary())], names=["block", "label", "dim", "lo", "hi", "cids", "ms", "x"])

        for b in batches:
            rows = pa.Table.from_batches([b]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([b])])
            while rows.num_rows:
                label, dim = rows.column("label").slice(0, block).to_numpy(), rows.column("dim").slice(0, block).to_numpy()
                same = (label == label[0]) & (dim == dim[0])
                end = int(np.argmin(same)) if not same.all() else len(same)
                if end == rows.num_rows and end < block:
                    break
                yield emit(rows.slice(0, end), number)
                rows, number = rows.slice(end), number + 1
            carry = rows if rows.num_rows else None
        if carry is not None:
            yield emit(carry, number)

    schema = "block long, label string, dim int, lo array<double>, hi array<double>, cids array<string>, ms array<long>, x binary"
    return materialize(ranged.mapInArrow(cut, schema), "blocks")


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(i, j), i <= j: pairs of blocks of one label whose boxes come within epsilon, found from long intervals down to blocks."""
    boxes = blocks.select("block", "label", "dim", "lo", "hi")
    k = len((boxes.select("lo").first() or [[]])[0])
    pairs = None
    for level, shift in enumerate(LEVELS):
        at = F.shiftright("block", shift)
        aggs = [f(F.col(c)[d]).alias(f"{c}{d}") for c, f in (("lo", F.min), ("hi", F.max)) for d in range(k)]
        nodes = boxes.groupBy("label", "dim", at.alias("node")).agg(F.count("*").alias("c"), *aggs)
        side = lambda s: nodes.select(*[F.col(c).alias(f"{s}_{c}") for c in nodes.columns])  # noqa: E731, B023
        a, b = side("a"), side("b")
        same = (F.col("a_label") == F.col("b_label")) & (F.col("a_dim") == F.col("b_dim")) & (F.col("a_node") <= F.col("b_node"))
        gaps = [F.greatest(F.lit(0.0), F.col(f"b_lo{d}") - F.col(f"a_hi{d}"), F.col(f"a_lo{d}") - F.col(f"b_hi{d}")) for d in range(k)]
        close = sum((g * g for g in gaps), F.lit(0.0)) <= epsilon * epsilon * (1 + 1e-9) + 1e-12
        if pairs is None:
            joined = a.join(b, same)
        else:
            fan = LEVELS[level - 1] - shift
            joined = pairs.join(a, (F.col("label") == F.col("a_label")) & (F.col("dim") == F.col("a_dim")) & (F.col("i") == F.shiftright("a_node", fan)))
            joined = joined.join(b, same & (F.col("j") == F.shiftright("b_node", fan)))
        pairs = joined.where(close).select(F.col("a_label").alias("label"), F.col("a_dim").alias("dim"), F.col("a_node").alias("i"), F.col("b_node").alias("j"))
    return pairs.select("i", "j")


def compare_blocks(pairs: DataFrame, blocks: DataFrame, cosine: float) -> DataFrame:
    """(cid, links, root): for each vertex of a pair of blocks with links there, their number and a vertex of its part.

    A tile holds at most 8 x 8 pairs and so 16 blocks; each block is sent to a tile once, with the partners it has there.
    """
    tiled = pairs.withColumn("ti", F.shiftright("i", TILE)).withColumn("tj", F.shiftright("j", TILE))
    rows_of = tiled.groupBy("ti", "tj", F.col("i").alias("block")).agg(F.collect_list("j").alias("partners"))
    columns_of = tiled.select("ti", "tj", F.col("j").alias("block")).distinct().join(rows_of.select("ti", "tj", "block"), ["ti", "tj", "block"], "left_anti")
    wanted = rows_of.unionByName(columns_of.withColumn("partners", F.array().cast("array<long>")))
    dealt = wanted.join(blocks.select("block", "dim", "cids", "ms", "x"), "block")

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def linked(ic, im, x, jc, jm, y, same: bool) -> pa.RecordBatch | None:
        g = unit(x) @ unit(y).T
        mask = g >= cosine
        for a, b in np.argwhere(np.abs(g - cosine) < 1e-9):  # rounding could decide: by the plain formula
            mask[a, b] = (x[a] * y[b]).sum() / np.sqrt((x[a] * x[a]).sum() * (y[b] * y[b]).sum()) >= cosine
        if same:
            mask &= mask.T
            np.fill_diagonal(mask, False)
        if not mask.any():
            return None
        ids = ic if same else ic + jc
        a_at = np.arange(len(ic))
        b_at = a_at if same else len(ic) + np.arange(len(jc))
        count = np.zeros(len(ids), np.int64)
        count[a_at] += mask @ jm
        if not same:
            count[b_at] += im @ mask
        root = np.arange(len(ids))
        while True:  # smallest label over links, until nothing changes
            a, b = root[a_at], root[b_at]
            new_a = np.minimum(a, np.where(mask, b, len(ids)).min(1))
            new_b = np.minimum(b, np.where(mask, new_a[:, None], len(ids)).min(0))
            if (new_a == a).all() and (new_b == b).all():
                break
            np.minimum.at(root, a_at, new_a)
            np.minimum.at(root, b_at, new_b)
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array([ids[k] for k in some]), pa.array(count[some]), pa.array([ids[k] for k in root[some]])], names=["cid", "links", "root"])

    def run(tile: pa.Table) -> pa.Table:
        held = {}
        for block, dim, cids, ms, x in zip(*(tile.column(c).to_pylist() for c in ("block", "dim", "cids", "ms", "x"))):
            held[block] = cids, np.array(ms, np.int64), np.frombuffer(x, np.float64).reshape(-1, dim)
        out = []
        for i, partners in zip(tile.column("block").to_pylist(), tile.column("partners").to_pylist()):
            out.extend(linked(*held[i], *held[j], i == j) for j in partners)
        schema = pa.schema([("cid", pa.string()), ("links", pa.int64()), ("root", pa.string())])
        return pa.Table.from_batches([b for b in out if b is not None], schema)

    return dealt.groupBy("ti", "tj").applyInArrow(run, "cid string, links long, root string")


def link_vectors(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each input row."""
    epsilon = float(np.sqrt(2 - 2 * cosine))
    rows = materialize(named_rows(vectors, id_col, vector_col, label_col), "vector-rows")
    points = rows.where("cid is not null").groupBy("cid").agg(F.any_value("label").alias("label"), F.any_value("dim").alias("dim"), F.any_value("x").alias("x"), F.min("id").alias("id"), F.count("*").alias("m"))
    points = materialize(points, "vertices")
    picked = points.orderBy("cid").limit(sample).select("x").collect()
    axes = principal([np.frombuffer(r.x, np.float64) for r in picked], DIMENSIONS)
    blocks = sequence_blocks(points, axes, epsilon, block)
    pairs = materialize(near_blocks(blocks, epsilon), "block-pairs")
    found = materialize(compare_blocks(pairs, blocks, cosine), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).select(F.col("a").alias("cid"), F.col("b").alias("root"))
    named = points.select("cid", "id", "m").join(counts, "cid", "left").join(comps, "cid", "left")
    named = materialize(named.select("cid", "id", "m", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "cid").alias("root")), "named")
    least = materialize(named.groupBy("root").agg(F.min("id").alias("least"), F.count("*").alias("c")), "least")
    done = spread_join(named, least, ["root"], "c").select("cid", "m", "links", "least")
    ids = rows.select("id", "cid")
    linked = spread_join(ids.where("cid is not null"), materialize(done, "done"), ["cid"], "m").select("id", "links", "least")
    apart = ids.where("cid is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("least"))
    out = linked.unionByName(apart).select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("least").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM e),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.93),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, count(*) AS n FROM l GROUP BY a),
m AS (SELECT a, least(a, min(b)) AS root FROM r GROUP BY a)
SELECT x.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(m.root, x.vec_id) AS component_id, coalesce(m.root, x.vec_id) = x.vec_id AS kept
FROM embeddings x LEFT JOIN c ON c.a = x.vec_id LEFT JOIN m ON m.a = x.vec_id
"""

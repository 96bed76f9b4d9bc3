"""Vector codes: parts of whole-number vectors named by their nearest codebook entries, found through metric trees.

Vectors are dealt into blocks of bounded size, where they lie. For each part position a block gets a metric tree over
its distinct parts, built middle out: anchors are grown one by one at the point farthest from its anchor, each taking
over the points that are nearer to it; pairs of anchors whose common ball is smallest are merged up to a root, and
anchors that still hold many points are divided in the same way. Each ball keeps the sum and the number of its vectors.

A round sends the codebooks, which have a fixed size, down the trees. A ball inherits its parent's candidate entries and
drops an entry j when another entry i is nearer for all of the ball: |c - j|^2 - |c - i|^2 > 2 r |i - j|, with a margin
for rounding that only ever keeps an entry too many. A ball with one candidate left is wholly owned and adds its sum and
number; parts in leaves that stay open compare with the candidates that are left, in whole numbers, ties to the lower
index. Sums are added in each task and then by (part, entry) in a shuffle; the driver gets one row an entry.

Trees are written once to the shared folder; rounds and the final assignment read them.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped; shorter vectors, and those
whose length 16 doesn't divide, count as if they ended in zeros; whole numbers beyond +-2**27 stay at that; with fewer
vectors than entries there are as many entries as vectors; the first entries are those of the smallest ids, null ids
last, equal ids by their vectors; equal entries stay apart and the lower index gets the parts; rows that repeat count
each; null labels are one label; an empty table gives an empty result; other input columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_table, materialize, modest_batches, spread_join
from .vectors import batches_of, finite_rows, whole, widest

PARTS, ENTRIES, ROUNDS = 16, 64, 2
BLOCK, LEAF = 4096, 48
BOUND = 1 << 27


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows, the number of the distinct row of each row, how often each occurs)."""
    low, span = x.min(0, initial=0), 1 + x.max(0, initial=0) - x.min(0, initial=0)
    if np.log2(span.astype(np.float64)).sum() < 62:
        key = (x - low) @ np.concatenate([np.cumprod(span[::-1])[-2::-1], [1]]) if x.shape[1] else np.zeros(len(x), np.int64)
        _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        return x[first], inverse, counts
    values, inverse, counts = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    return values, inverse.reshape(-1), counts


@dataclass
class Tree:
    """Balls over distinct points put in an order in which each ball is one stretch, start to end; children follow by number.

    left and right are -1 in leaves; row_of gives each vector of the block its point.
    """

    points: np.ndarray
    counts: np.ndarray
    row_of: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    weight: np.ndarray
    radius: np.ndarray


def grow_anchors(p: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor of each point: anchors start at the point farthest from its anchor and take the points nearer to them."""
    owner, far = np.zeros(len(p), np.int64), ((p - p[0]) ** 2).sum(1)
    for k in range(1, wanted):
        new = int(far.argmax())
        if far[new] == 0:
            break
        d = ((p - p[new]) ** 2).sum(1)
        nearer = d < far
        owner[nearer], far[nearer] = k, d[nearer]
    return owner


def build_tree(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """The anchors hierarchy over the rows of x."""
    points, row_of, counts = distinct_rows(x)
    p, w = points.astype(np.float64), counts.astype(np.float64)
    nodes: list[tuple] = []  # (left, right, members of a leaf)

    def divide(members: np.ndarray) -> int:
        if len(members) <= leaf:
            nodes.append((-1, -1, members))
            return len(nodes) - 1
        owner = grow_anchors(p[members], max(2, int(np.sqrt(len(members)))))
        groups = [members[owner == k] for k in range(owner.max() + 1)]
        ids = [divide(g) for g in groups]
        centre = np.array([np.average(p[g], axis=0, weights=w[g]) for g in groups])
        radius = np.array([np.sqrt(((p[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre)])
        weight = np.array([w[g].sum() for g in groups])

        def joint(k: int) -> np.ndarray:
            """Radius of the ball around k and each other anchor."""
            apart = np.sqrt(((centre - centre[k]) ** 2).sum(1))
            share = weight / (weight + weight[k])  # how far the joint centre lies from k
            out = np.maximum(apart * share + radius[k], apart * (1 - share) + radius)
            out[k] = np.inf
            return out

        cost = np.array([joint(k) for k in range(len(groups))])
        for _ in range(len(groups) - 1):
            a, b = divmod(int(cost.argmin()), len(groups))
            nodes.append((ids[a], ids[b], None))
            ids[a], r = len(nodes) - 1, cost[a, b]
            centre[a] = (centre[a] * weight[a] + centre[b] * weight[b]) / (weight[a] + weight[b])
            weight[a], radius[a] = weight[a] + weight[b], r
            gone = np.isinf(cost).all(1)
            gone[b] = True
            row = joint(a)
            row[gone] = np.inf
            cost[a] = cost[:, a] = row
            cost[b] = cost[:, b] = np.inf
        return len(nodes) - 1

    root = divide(np.arange(len(points)))
    number, order, start, end, left, right = {}, [], [], [], [], []
    stack = [(root, False)]
    while stack:  # parents before children, points in the order of leaves
        node, done = stack.pop()
        if done:
            end[number[node]] = len(order)
            continue
        number[node] = len(start)
        start.append(len(order))
        end.append(0)
        a, b, members = nodes[node]
        left.append(a)
        right.append(b)
        stack.append((node, True))
        if members is None:
            stack += [(b, False), (a, False)]
        else:
            order.extend(members)
    left, right = (np.array([number.get(c, -1) for c in side], np.int32) for side in (left, right))
    start, end, order = np.array(start, np.int32), np.array(end, np.int32), np.array(order, np.int64)
    points, counts, p = points[order], counts[order], p[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    run = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points * counts[:, None], 0)])
    many = np.concatenate([[0], np.cumsum(counts)])
    sums, weight = run[end] - run[start], many[end] - many[start]
    centres = sums / weight[:, None]
    radius = np.array([np.sqrt(((p[s:e] - c) ** 2).sum(1).max()) for s, e, c in zip(start, end, centres)])
    return Tree(points.astype(np.int32), counts.astype(np.int32), place[row_of].astype(np.int32), start, end, left, right, sums, weight, radius * (1 + 1e-12))


def owners(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point, sums, counts of each entry): balls go down with their candidates until one is left or they are leaves."""
    size, width = entries.shape
    sums, counts = np.zeros((size, width), np.int64), np.zeros(size, np.int64)
    entry = np.full(len(tree.points), -1, np.int64)
    first = np.sort(np.unique(entries, axis=0, return_index=True)[1])  # of equal entries the lowest
    e = entries[first]
    between = np.sqrt(((e[:, None].astype(np.float64) - e[None]) ** 2).sum(2))
    balls, open_ = np.zeros(1, np.int64), np.ones((1, len(e)), bool)
    leaves, left_open = [], []
    while len(balls):
        centre, r = tree.sums[balls] / tree.weight[balls, None], tree.radius[balls, None]
        d = ((centre[:, None] - e[None]) ** 2).sum(2)
        best = np.where(open_, d, np.inf).argmin(1)
        reach, nearest = 2 * r * between[best], d[np.arange(len(balls)), best][:, None]
        open_ = open_ & ~(d - nearest > reach + 1e-9 * (1 + d + nearest + reach))
        owned = open_.sum(1) == 1
        for b, k in zip(balls[owned], first[best[owned]]):
            entry[tree.start[b] : tree.end[b]] = k
            sums[k] += tree.sums[b]
            counts[k] += tree.weight[b]
        is_leaf = tree.left[balls] < 0
        leaves.append(balls[~owned & is_leaf])
        left_open.append(open_[~owned & is_leaf])
        inner = ~owned & ~is_leaf
        balls, open_ = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]]).astype(np.int64), np.concatenate([open_[inner]] * 2)
    for ball, mask in zip(np.concatenate(leaves), np.concatenate(left_open)):
        s, stop, among = tree.start[ball], tree.end[ball], np.flatnonzero(mask)
        here = tree.points[s:stop].astype(np.int64)
        k = first[among[((here[:, None] - e[among][None]) ** 2).sum(2).argmin(1)]]
        entry[s:stop] = k
        np.add.at(sums, k, here * tree.counts[s:stop, None])
        np.add.at(counts, k, tree.counts[s:stop])
    return entry, sums, counts


def blocks_of(rows: DataFrame, width: int, parts: int, block: int, leaf: int) -> DataFrame:
    """(ids, labels, trees): blocks of rows, with a tree for each part position."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches_of(batches, block):
            x = whole(t.column("v").combine_chunks(), width, BOUND)
            trees = [vars(build_tree(x[:, k * (width // parts) : (k + 1) * (width // parts)], leaf)) for k in range(parts)]
            wide = lambda c: pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(c).combine_chunks())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([wide("id"), wide("label"), pa.array([pickle.dumps(trees, 5)], pa.binary())], names=["ids", "labels", "trees"])

    return materialize(rows.mapInArrow(run, f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, trees binary"), "code-blocks")


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Tree]]]:
    for b in batches:
        for at in range(b.num_rows):
            one = b.slice(at, 1)
            yield one, [Tree(**t) for t in pickle.loads(one.column(one.num_columns - 1)[0].as_py())]


def refine(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, place) after one round: entries become their parts' mean, rounded down; unused ones stay."""
    parts, size, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
        for _, trees in _each_block(batches):
            for k, tree in enumerate(trees):
                _, s, c = owners(tree, codebooks[k])
                sums[k] += s
                counts[k] += c
        part, entry = counts.nonzero()
        cells = [pa.array(sums[part, entry, d]) for d in range(width)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), *cells], names=["part", "entry", "n", *(f"s{d}" for d in range(width))])

    schema = "part long, entry long, n long" + "".join(f", s{d} long" for d in range(width))
    totals = [F.sum(F.col(f"s{d}").cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    out = codebooks.copy()
    for r in blocks.select("trees").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():  # parts * size rows at most
        out[r.part, r.entry] = [int(r[f"s{d}"]) // r.n for d in range(width)]
    return out


def assign(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every vector."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in blocks.schema if f.name in ("ids", "labels")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, trees in _each_block(batches):
            codes, errors = [], 0
            for k, tree in enumerate(trees):
                entry, _, _ = owners(tree, codebooks[k])
                far = ((tree.points - codebooks[k][entry]) ** 2).sum(1)
                codes.append(entry[tree.row_of])
                errors = errors + far[tree.row_of]
            text = [bytes(r).hex() for r in np.array(codes, np.uint8).T]
            yield pa.RecordBatch.from_arrays([one.column(0).flatten(), one.column(1).flatten(), pa.array(text, pa.string()), pa.array(errors, pa.int64())], names=["id", "label", "code", "error"])

    return blocks.select("ids", "labels", "trees").mapInArrow(run, f"id {kinds['ids']}, label {kinds['labels']}, code string, error long")


def vector_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK, leaf: int = LEAF
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256), one row for each vector that isn't dropped; entries may be 256 at most."""
    if not 0 < entries <= 256:
        raise ValueError("codes have two hex digits a part: 1 to 256 entries")
    modest_batches(vectors.sparkSession)
    rows = finite_rows(vectors, vector_col, id=id_col, label=label_col)
    width = max(1, -(-widest(rows) // parts)) * parts
    blocks = blocks_of(rows, width, parts, block, leaf)
    smallest = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()  # `entries` rows
    seeds = whole(smallest.column("v").combine_chunks(), width, BOUND) if smallest.num_rows else np.zeros((0, width), np.int64)
    codebooks = seeds.reshape(len(seeds), parts, width // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(seeds) else 0):
        codebooks = refine(blocks, codebooks)
    coded = materialize(assign(blocks, codebooks), "codes")
    drop_table(blocks)
    named = coded.select("id", "code", "error", F.col("label").isNull().alias("none"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label"))
    errors = materialize(named.groupBy("none", "label").agg(F.count("*").alias("c"), F.try_sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    out = spread_join(named, errors, ["none", "label"], "c")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _round(k: int) -> str:
    return f"""
n{k} AS MATERIALIZED (SELECT p.r, p.part, p.v, arg_min(c.entry, d.d * 64 + c.entry) AS entry, min(d.d) AS d
  FROM p JOIN c{k} c ON p.part = c.part, LATERAL (SELECT list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d) d GROUP BY p.r, p.part, p.v),"""


def _update(k: int) -> str:
    return f"""
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN
  (SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY i) AS v FROM (SELECT part, entry, i, sum(v[i])::DOUBLE AS s, count(*) AS n FROM n{k}, range(1, 5) t(i) GROUP BY part, entry, i) GROUP BY part, entry) m
  ON m.part = c.part AND m.entry = c.entry),"""


ORACLE_SQL = f"""
WITH e AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, list_slice(x, part * 4 + 1, part * 4 + 4) AS v FROM e, range(0, 16) t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM p WHERE r <= 64),{_round(0)}{_update(0)}{_round(1)}{_update(1)}{_round(2)}
w AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n2 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT e.vec_id, w.code, w.error, sum(w.error) OVER (PARTITION BY e.label)::BIGINT AS label_error, h.codebooks_sha256 FROM e JOIN w ON w.r = e.r, h
"""

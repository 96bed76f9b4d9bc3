"""The inverted-file index: recall against exact search, hot lists, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators import dense, vector_index


def frame(spark, x, start=0):
    return spark.createDataFrame([(start + k, [float(c) for c in v]) for k, v in enumerate(x)], "vec_id long, embedding array<double>")


def queries(vectors, every=20):
    return vectors.where(f"vec_id % {every} = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def test_recall_on_given_vectors(spark):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    index = vector_index.build(v)
    found = index.search(queries(v, 50), 5)
    exact = dense.nearest(queries(v, 50), v, 5)
    assert vector_index.measured_recall(found, exact) >= 0.9
    assert {r["list"]: r.n for r in index.blocks.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).collect()} and index.blocks.agg(F.sum(F.size("ids"))).first()[0] == v.count()


def test_clusters_need_few_lists(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(25, 16))
    v = frame(spark, centres[rng.integers(0, 25, 2000)] + 0.1 * rng.normal(size=(2000, 16)))
    index = vector_index.build(v, lists=25)
    assert index.probes <= 8
    found, exact = index.search(queries(v), 5), dense.nearest(queries(v), v, 5)
    assert vector_index.measured_recall(found, exact) >= 0.9
    everywhere = index.search(queries(v), 5, probes=len(index.centroids))
    key = lambda r: (r.query_id, r["rank"])
    assert [tuple(r)[:2] for r in sorted(everywhere.collect(), key=key)] == [tuple(r)[:2] for r in sorted(exact.collect(), key=key)]


def test_a_list_with_most_rows_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 100)
    x = np.concatenate([np.tile([1.0, 0.0, 0.0], (900, 1)), np.eye(3), -np.eye(3)])
    v = frame(spark, x)
    index = vector_index.build(v, lists=4)
    sizes = [r.n for r in index.blocks.select(F.size("ids").alias("n")).collect()]
    assert sum(sizes) == len(x) and max(sizes) < 200 and len(sizes) >= 9
    got = index.search(queries(v, 300), 3).where("query_id = 300").orderBy("rank").collect()
    assert [(r.vec_id, round(r.cosine, 6)) for r in got] == [(0, 1.0), (1, 1.0), (2, 1.0)]


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [0.9, 0.1]), (None, [1.0, 1.0]), (6, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vector_index.build(v, lists=2)
    got = index.search(v.select(F.col("vec_id").alias("query_id"), "embedding"), 2, probes=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got if r.query_id in (1, 5)] == [(1, 5), (1, 6), (5, 1), (5, 6)]
    assert {r.query_id for r in got} == {1, 5, 6}
    empty = vector_index.build(v.limit(0))
    assert empty.search(v.select(F.col("vec_id").alias("query_id"), "embedding"), 2).count() == 0


def test_no_cross_join(spark):
    v = frame(spark, np.random.default_rng(1).normal(size=(200, 4)))
    plan = vector_index.build(v, lists=5).search(queries(v), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("n", [1, 2, 7])
def test_few_vectors(spark, n):
    v = frame(spark, np.random.default_rng(n).normal(size=(n, 3)))
    assert vector_index.build(v).search(queries(v, 1), 5, include_self=True).where("rank = 1").count() == n

"""Semantic chunks and ordered scans against plain loops."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrylight.operators import ordered, semantic
from quarrylight.operators.embedding import AT_ONCE, Embedder, hashing, neighbour_similarity


def plain_chunks(text, embedder, share=0.3, threshold=None, longest=10):
    pieces = [p.strip(" \t\n\r\x0b\x0c") for p in re.findall(r"[^。！？.!?\n]*[。！？.!?\n]|[^。！？.!?\n]+$", text or "")]
    pieces = [p for p in pieces if p]
    x = embedder.encode(pieces) if pieces else np.zeros((0, 1))
    sims = [float(a @ b) / max(math.sqrt(a @ a) * math.sqrt(b @ b), 1e-300) for a, b in zip(x, x[1:])]
    cut = threshold if threshold is not None else np.percentile(sims, 100 * share) if sims else 0
    out, held = [], []
    for k, p in enumerate(pieces):
        held.append(p)
        if k == len(pieces) - 1 or round(sims[k], 9) < round(cut, 9) or len(held) == longest:
            out.append("".join(held))
            held = []
    return out


def test_chunks_match_a_plain_loop(spark):
    rng = random.Random(6)
    words = "red blue green one two three 数据 模型 x1 y2".split()
    sentence = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) + rng.choice([".", "! ", "\n", "。", "?  "])
    texts = ["".join(sentence() for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, "", " \n ", "one", "no end mark", "a. a. a. a. a. a. a. a. a. a. a. a. a."]
    docs = spark.createDataFrame([(k, t, "e") for k, t in enumerate(texts)], "doc_id long, text string, extra string")
    for kw in ({}, {"share": 0.0}, {"share": 1.0}, {"threshold": 0.4}, {"longest": 1}, {"longest": 3, "share": 0.5}):
        got = {}
        for r in semantic.chunks(docs, hashing(16), **kw).orderBy("doc_id", "chunk").collect():
            got.setdefault(r.doc_id, []).append(r.text)
        assert got == {k: c for k, t in enumerate(texts) if (c := plain_chunks(t, hashing(16), **kw))}, kw


def test_long_texts_are_encoded_piece_by_piece(spark):
    seen = []

    def encode(given):
        seen.append(len(given))
        assert len(given) <= 2048
        return np.array([[1.0, len(t)] for t in given])

    docs = spark.createDataFrame([(1, "".join("ab" * (k % 3 + 1) + "." for k in range(2 * AT_ONCE + 5)))], "doc_id long, text string")
    got = docs.select(neighbour_similarity(F.split(F.col("text"), r"\."), Embedder("n", 2, {}, encode)).alias("s")).first().s
    vectors = [np.array([1.0, 2 * (k % 3 + 1)]) for k in range(2 * AT_ONCE + 5)] + [np.array([1.0, 0.0])]
    want = [a @ b / math.sqrt((a @ a) * (b @ b)) for a, b in zip(vectors, vectors[1:])]
    assert np.allclose(got, want)


def test_wrong_settings_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for kw in ({"longest": 0}, {"share": 1.5}):
        with pytest.raises(ValueError):
            semantic.chunks(docs, hashing(4), **kw)


def vectors(spark, n=700):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 3)], [None, 1, 1, 1, 2][k % 5] if k < n - 1 else 9) for k in range(n)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def plain_segments(rows, share=0.3, longest=10):
    out = []
    for label in {r[2] for r in rows}:
        mine = sorted((r for r in rows if r[2] == label), key=lambda r: r[0])
        sims = [None]
        for a, b in zip(mine, mine[1:]):
            a, b = np.array(a[1]), np.array(b[1])
            norm = (a @ a) * (b @ b)
            sims.append(float(a @ b / math.sqrt(norm)) if norm else None)
        known = [s for s in sims if s is not None]
        cut = np.percentile(known, 100 * share) if known else None
        part, nth = 0, 0
        for r, s in zip(mine, sims):
            if s is not None and round(s, 9) < round(float(cut), 9):
                part, nth = part + 1, 0
            out.append((r[0], label, part, nth // longest))
            nth += 1
    return sorted(out, key=lambda r: r[0])


def test_segments_of_groups_in_many_ranges(spark):
    rows, df = vectors(spark)
    spark.conf.set("spark.sql.ansi.enabled", "false")  # a zero vector's cosine is null
    try:
        for size in (17, 100_000):
            got = ordered.segments(df, "label", "vec_id", rows=size, longest=4).select("vec_id", "label", "part", "sub").orderBy("vec_id").collect()
            assert [tuple(r) for r in got] == plain_segments(rows, longest=4)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert ordered.segments(df.limit(0), "label", "vec_id").count() == 0


def test_no_window_holds_a_group(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    ranged = ordered.in_ranges(df, "g", "o", rows=500)
    assert ranged.groupBy("range").count().agg(F.max("count")).first()[0] < 1500
    got = ordered.running(ranged, F.col("o"), "s", "sum").where("o in (0, 499, 500, 4999)").orderBy("o").collect()
    assert [r.s for r in got] == [k * (k + 1) // 2 for k in (0, 499, 500, 4999)]


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 0.999, 1.0])
def test_percentiles_are_exact(spark, share):
    rng = np.random.default_rng(1)
    rows = [(int(g) if g else None, float(x)) for g, x in zip(rng.integers(0, 3, 900), np.round(rng.uniform(-1, 1, 900), 2))] + [(1, None), (7, -1.0), (8, 1.0)]
    rows += [(2, 0.25)] * 500
    got = {r.g: r.cut for r in ordered.exact_percentile(spark.createDataFrame(rows, "g int, x double"), share).collect()}
    for g in {r[0] for r in rows}:
        assert abs(got[g] - np.percentile([x for k, x in rows if k == g and x is not None], 100 * share)) < 1e-12


def test_windows_agree_with_plain_ones(spark):
    _, df = vectors(spark, 300)
    got = ordered.with_previous(ordered.in_ranges(df.select("vec_id", "label"), "label", "vec_id", rows=11).withColumn("v", F.col("o")), "v")
    w = Window.partitionBy("label").orderBy("vec_id")
    want = df.withColumn("before", F.lag("vec_id").over(w)).withColumn("first", F.row_number().over(w) == 1)
    key = lambda r: r[0]
    assert sorted(map(tuple, got.select("o", "before", "first").collect()), key=key) == sorted(map(tuple, want.select("vec_id", "before", "first").collect()), key=key)

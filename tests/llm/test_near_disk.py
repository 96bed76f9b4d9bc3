"""What near deduplication shuffles and leaves on disk, and that its results stay the same."""

import collections
import random

import pytest
from pyspark.sql import functions as F
from test_llm_operators import brute_groups, near_rows, table

from quarrylight.llm import common, minhash


@pytest.fixture
def written(monkeypatch):
    """Working tables as they are made: (name, rows), and the folders that stay."""
    made, folders = [], {}

    def recorded(df, name):
        out = common.materialize(df, name)
        made.append((name, out.count()))
        folders[f"{name}#{len(made)}"] = out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        return out

    monkeypatch.setattr(minhash, "materialize", recorded)
    return made, folders


def texts(groups, words, changed, seed=3):
    """Groups of texts of which any two share most words, and as many texts that share nothing."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    out = []
    for size in groups:
        base = [word() for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for at in rng.sample(range(words), changed):
                copy[at] = word()
            out.append(" ".join(copy))
        out.append(" ".join(word() for _ in range(words)))
    return list(enumerate(out))


def test_signatures_and_sets_go_as_soon_as_they_are_not_needed(spark, written):
    import os

    minhash.deduplicate(table(spark, near_rows())).collect()
    left = {name.split("#")[0] for name, folder in written[1].items() if os.path.exists(folder)}
    assert left and not left & {"sketch", "classes", "sets"}


def test_only_classes_that_share_a_bucket_go_on(spark, written):
    rows = texts([2, 3], 100, 1) + [(1000 + k, f"alone {k} " + " ".join(f"{k}w{i}" for i in range(20))) for k in range(200)]
    got = minhash.groups(table(spark, rows), minhash.FIVE_WORDS).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, 5, 80)
    made = dict(written[0])
    assert made["classes"] == 207 and made["sharing"] == 5


def test_listed_pairs_are_not_compared_again_with_full_sets(spark, written):
    rows = texts([4] * 12, 200, 5)  # any two share about 0.6 of their shingles: they survive pruning and aren't linked
    rule = minhash.Rule(words=5, percent=80, rows=4, miss=1e-9)
    got = minhash.groups(table(spark, rows), rule).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, 5, 80)
    names = [name for name, _ in written[0]]
    assert dict(written[0])["best"] > 0 and "rest" not in names


def test_unlisted_pairs_are_compared_again(spark, written):
    rows = texts([6] * 8, 200, 3)
    got = minhash.groups(table(spark, rows), minhash.Rule(words=5, percent=80, rows=4, best=1, block=4)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, 5, 80)
    assert "rest" in [name for name, _ in written[0]]


def test_too_many_ids_to_broadcast(spark, monkeypatch, written):
    monkeypatch.setattr(minhash, "is_small", lambda df: False)
    rows = near_rows()
    got = minhash.groups(table(spark, rows), minhash.FIVE_WORDS).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, 5, 80)
    kept = {i for i, _, c in brute_groups(rows, 5, 80) if i == c}
    out = [r.doc_id for r in minhash.deduplicate(table(spark, rows)).collect()]
    assert set(out) - {None} == kept - {None} and len(out) == len(set(out))
    assert {"wanted-bits", "gone-bits"} <= {name for name, _ in written[0]}


def test_a_bit_table_marks_its_keys_and_hardly_any_others(spark):
    ids = spark.range(20_000).select(F.col("id").alias("k"))
    keys = ids.where("k % 100 = 7").union(spark.sql("select cast(null as bigint)"))
    marked = common.with_bit(ids.union(spark.sql("select cast(null as bigint)")), common.bit_table(keys, common.bit_of("k")), "m", "k").where("m")
    got = {r.k for r in marked.collect()}
    assert {None, *range(7, 20_000, 100)} <= got and len(got) < 210

"""Columns whose names clash with what operators add, repeated rows, ties and empty tables; stages of the pipeline included."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrylight.llm import exact_dedup, minhash, toxicity, vector_links, warc

CLASH = "doc_id long, text string, lang string, source string, n_chars long, __id long, __sha string, __score double, __t string, bits int, bucket int, fp string, kept boolean, score double, key string"
LONG = "long word " * 20_000


def rows_of():
    texts = [None, "", "  ", "one", LONG, "a b c d e f g h", "a b c d e f g h", "A B C D E F G H", "a  b c d e f g h", "x y z", "x y z"]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]
    return [(i, t, "en", "s", len(t or ""), 9, "sha", 0.5, "t", 1, 2, "fp", True, 0.1, "k") for i, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def clashing(spark):
    return spark.createDataFrame(rows_of(), CLASH)


def test_names_that_clash_come_back_unchanged(spark, clashing):
    model = toxicity.fit(["good words here", "bad words there"] * 10, [0, 1] * 10)
    for out in (exact_dedup.deduplicate(clashing), minhash.deduplicate(clashing), toxicity.reject(clashing, model)):
        assert out.columns == clashing.columns
        assert {tuple(r)[5:] for r in out.collect()} <= {r[5:] for r in rows_of()}
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(clashing).collect()) == [1, 3, 4, 5, 6, 8, 10]
    assert sorted(r.doc_id for r in minhash.deduplicate(clashing).collect()) == [1, 2, 3, 4, 5, 6, 10]


def test_only_open_rows_are_digested(spark):
    rows = [(k, f"{'x' * k} text") for k in range(50)] + [(100, "x text"), (101, "y text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    digested = {r.doc_id for r in exact_dedup.with_digests(docs, "text", 64).where("__sha is not null").collect()}
    assert digested == {1, 100}
    got = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.groups(docs, all_digests=False).collect()}
    assert got[100] == (1, 2, hashlib.sha256(b"x text").hexdigest()) and got[101] == (101, 1, None)


def test_equal_prefixes_and_lengths_are_told_apart_by_the_full_hash(spark):
    same = "p" * 100
    docs = spark.createDataFrame([(1, same + "a"), (2, same + "b"), (3, same + "a")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.groups(docs).collect()} == {(1, 1, True), (2, 2, True), (3, 1, False)}


def test_a_hot_group_is_spread(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("t "), F.col("id").cast("string"))).otherwise("copy").alias("text"))
    got = collections.Counter((r.keep_id, r.group_size, r.kept) for r in exact_dedup.groups(docs).where("text_sha256 is not null and group_size > 1").collect())
    assert got == {(1, 2666, True): 1, (1, 2666, False): 2665}
    got = minhash.groups(docs).where("component_id = 1").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (2666, 1)
    vectors = spark.range(4000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.col("id") + 1.0, F.lit(1.0))).otherwise(F.array(F.lit(0.0), F.lit(-1.0))).alias("embedding"), F.lit(1).alias("label"))
    assert vector_links.link_vectors(vectors).where("n_links = 2665 and component_id = 1").count() == 2666


def test_a_changed_payload_stops_the_reading(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>one</p>"), (2, "u", "<p>two</p>"), (3, "u", "<p>one</p>")], "page_id long, url string, html string")
    warc.write(pages, f"{tmp_path}/w")
    stored = spark.read.parquet(f"{tmp_path}/w/payloads").collect()
    for change in (lambda p: p.replace(b"two", b"tw0"), lambda p: p + b"!"):
        spark.createDataFrame([(r.sha256, bytearray(change(bytes(r.payload)))) for r in stored], "sha256 string, payload binary").write.mode("overwrite").parquet(f"{tmp_path}/w/payloads")
        with pytest.raises(Exception, match="does not fit|not as long"):
            warc.read_index(spark, f"{tmp_path}/w").collect()


STAGE_ROWS = [(1, None), (2, ""), (3, "  "), (4, LONG), (5, "call me at +1 (415) 555-2671 or write to a.b@example.com now please"), (6, "one two three four five six seven eight nine ten"), (7, "one  two three four five six seven eight nine ten"), (8, "ONE two three four five six seven eight nine ten"), (9, "tie"), (9, "tie"), (10, "tie")]
KEPT = {"toxicity": [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10], "exact_dedup": [1, 3, 4, 5, 6, 8, 9], "near_dedup": [1, 2, 3, 4, 5, 6, 9], "pii": [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10]}


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("stages"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, labelled, name, stage):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1.0, 7) for i, t in STAGE_ROWS], "doc_id long, text string, lang string, source string, n_chars long, __id string, score double, uid long")
    out = stage(spark, docs, labelled)
    empty = stage(spark, docs.limit(0), labelled)
    assert empty.count() == 0 and empty.columns == out.columns
    rows = out.collect()
    if name == "packing":
        assert collections.Counter(r.doc_id for r in rows if r.piece == 0) == collections.Counter(i for i, _ in STAGE_ROWS)
        assert sum(r.length for r in rows if r.doc_id == 4) > 2048 and all(r.length <= 2048 for r in rows)
        return
    assert out.columns == docs.columns and sorted(r.doc_id for r in rows) == KEPT[name]
    assert {(r["__id"], r.score, r.uid) for r in rows} == {("x", 1.0, 7)}
    if name == "pii":
        text = {r.doc_id: (r.text, r.n_chars) for r in rows}
        assert text[1] == (None, None) and text[2] == ("", 0) and text[5][0] == "call me at [PHONE] or write to [EMAIL] now please" and text[5][1] == len(text[5][0])

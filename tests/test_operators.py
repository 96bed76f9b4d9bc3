"""Operators that the tables can't exercise, on small inline fixtures."""

import numpy as np
from pyspark.sql import functions as F

from quarrylight.functions import text
from quarrylight.operators import chunking, decisions, dense, fusion, layout, lexical


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_tokenisers_on_ideographs(spark):
    assert one(spark, text.word_tokens, "Ab_1 编号文 x中") == ["ab_1", "编号", "号文", "x", "中"]
    assert one(spark, lambda c: text.lexical_tokens(text.folded(c)), "１１０kV 编号文") == ["110kv", "编号", "号文", "编号文"]
    assert one(spark, text.sentences, "好。3.14 x!\n y") == ["好。", "3.", "14 x!", "y"]
    assert one(spark, text.normalized_dates, "2024年1月5日 2024-01-05 2023/12/1") == ["2024-01-05", "2023-12-01"]


def test_lines_and_times(spark):
    assert one(spark, text.lines, "a\n\nb\r\n") == ["a", "", "b"] and one(spark, text.lines, "") == []
    assert [len(x) for x in one(spark, text.bounded_lines, "x" * 700)] == [300, 300, 100]
    assert one(spark, lambda c: text.subtitle_time(c.cast("double")), "59.9996") == "00:01:00,000"
    assert one(spark, lambda c: text.clock(c.cast("double")), "3661.5") == "01:01:01.50"


def test_chunkers():
    assert chunking.recursive("a b", 10, 2) == ["a b"] and chunking.recursive("  ", 10, 2) == []
    assert chunking.recursive("aaaa\nbbbb", 5, 2) == ["aaaa", "aabbbb"]
    assert chunking.recursive("abcdefg", 3, 0) == list("abcdefg")
    source = "\n".join(f"line {k} of a text" for k in range(60))
    for start, piece in chunking.merging(source, 100, 30):
        assert len(piece) <= 100 and source[start : start + len(piece)] == piece
    assert "".join(chunking.subtitle_pieces("a,bb.cccccc", 4)) == "a,bb.cccccc"


def test_fusion_and_ranking(spark):
    d = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "item_id int, doc_id int, rank int")
    s = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "item_id int, doc_id int, rank int")
    got = {r.doc_id: r.score for r in fusion.reciprocal_ranks([(d, 1.0), (s, 1.0)], "item_id", "doc_id").collect()}
    assert max(got, key=got.get) == 11 and got[10] == 1 / 61
    flat = spark.createDataFrame([(1, 5.0), (1, 5.0)], "item_id int, score double")
    assert [r.norm for r in fusion.min_max(flat, "item_id").collect()] == [1.0, 1.0]
    ranked = spark.createDataFrame([(1, k, "a" if k < 5 else "b", k) for k in range(1, 7)], "item_id int, doc_id int, source string, rank int")
    assert [r.doc_id for r in lexical.diversified(ranked, "source", 2, 4).orderBy("place").collect()] == [1, 2, 5, 6]


def test_diverse_choice_matches_greedy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 6))
    vectors = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<double>")
    near = dense.nearest(vectors.where("vec_id = 0").select(F.col("vec_id").alias("query_id"), "embedding"), vectors, 10)
    got = [r.vec_id for r in dense.diverse(near, vectors, 4).orderBy("place").collect()]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pool, chosen = sorted(range(1, 30), key=lambda k: -unit[0] @ unit[k])[:10], []
    while len(chosen) < 4:
        worth = {k: 0.65 * unit[0] @ unit[k] - 0.35 * max((unit[k] @ unit[c] for c in chosen), default=0) for k in pool if k not in chosen}
        chosen.append(max(worth, key=worth.get))
    assert got == chosen


def test_layout(spark):
    e = spark.createDataFrame([("d", 0, "heading", 1, "A", None), ("d", 1, "text", 1, "x", None), ("d", 2, "text", 2, "y", None), ("d", 3, "caption", 2, "c", None)], "doc string, index int, type string, page int, content string, bbox array<double>")
    assert [r.section_title for r in layout.section_titles(e).orderBy("index").collect()] == ["", "A", "A", "A"]
    assert [r.captions for r in layout.nearby_captions(e).orderBy("index").collect()] == [["c"], ["c"], ["c"], []]
    assert [(r.page, r.text) for r in layout.page_texts(e).orderBy("place").collect()] == [(1, "A\n\nx"), (2, "y\n\nc")]
    s = spark.createDataFrame([("m", 0, 1.0, 1.0), ("m", 1, 2.0, 1.0)], "media string, pos int, start double, end double")
    assert [r.end for r in layout.repaired_segments(s).orderBy("pos").collect()] == [2.0, 2.1]


def test_decisions(spark):
    c = spark.createDataFrame([("",), ("short",), ("x" * 50,), ("The text is unclear, it may show a diagram of pumps",)], "t string")
    assert [r.q for r in c.select(decisions.caption_quality(F.col("t")).alias("q")).collect()] == ["empty", "too_short(<40 chars)", "", "uncertainty_markers: unclear"]
    boxes = [[0.0, 100.0, 10.0, 110.0], [1.0], [0.0, 50.0, 10.0, 500.0], [0.0, 10.0, 10.0, 70.0], [0.0, 725.0, 30.0, 735.0, 9.0], None]
    b = decisions.bbox_metrics(spark.createDataFrame([(k, x) for k, x in enumerate(boxes)], "k int, bbox array<double>")).orderBy("k").collect()
    assert [x.at_edge for x in b] == [False, False, False, True, True, False] and b[0].area == 100.0 and b[1].area is None and b[4].ratio == 3.0
    items = [("supported", 0, 0, "none", "stop"), ("supported", 2, 1, "none", "answer"), ("supported", 1, 1, "scope", "search"), ("missing", 0, 0, "corpus_missing", "stop"), ("partial", 1, 1, "output", "read"), ("partial", 1, 1, "conditions", "read"), ("supported", 1, 1, "none", "answer")]
    r = spark.createDataFrame(items, "s string, ids int, valid int, gap string, act string")
    got = [tuple(x.o) for x in r.select(decisions.report_status(*map(F.col, ("s", "ids", "valid", "gap", "act"))).alias("o")).collect()]
    assert got == [("unsupported", "unknown", "stop"), ("unsupported", "unknown", "stop"), ("partial", "scope", "search"), ("unsupported", "unknown", "stop"), ("partial", "output", "answer"), ("partial", "conditions", "clarify"), ("supported", "none", "answer")]
    asked = [
        ("hello there", "general", "direct", False, False, False, None, "running", "normal"),
        ("what about v 3?", "general", "direct", False, False, False, None, "ready", "normal"),
        ("facts", "general", "direct", False, True, False, None, "failed", "normal"),
        ("by the guide", "document", "research", False, False, True, 0, "ready", "normal"),
        ("by the guide", "document", "research", False, False, True, 2, "ready", "normal"),
        ("by the guide", "document", "research", False, False, True, None, "ready", "normal"),
        ("by the guide", "general", "direct", False, False, True, 1, "ready", "normal"),
        ("deep", "general", "clarify", False, False, False, None, "ready", "high"),
        ("deep", "general", "direct", False, False, False, None, "ready", "high"),
    ]
    p = spark.createDataFrame(asked, "q string, intent string, route string, ko boolean, scoped boolean, wants boolean, m int, prep string, lvl string")
    got = [tuple(x.o) for x in p.select(decisions.policy_route(*map(F.col, p.columns)).alias("o")).collect()]
    assert got == [("direct", ""), ("research", ""), ("research", "corpus_failed"), ("clarify", "scope_missing"), ("clarify", "scope_ambiguous"), ("clarify", "scope_ambiguous"), ("research", ""), ("clarify", ""), ("research", "")]
    images = [("image", "a.png", True, 100.0, 1.0, False, "", "x" * 50), ("figure", "a.png", True, 9e4, 1.0, False, "", ""), ("image", "a.pdf", True, 9e4, 1.0, False, "", ""), ("image", "a.png", False, 9e4, 1.0, False, "", ""), ("image", "a.png", None, 9e3, 9.0, False, "", ""), ("image", "a.png", None, 5e3, 2.0, True, "", ""), ("image", "a.png", None, None, None, False, "Our Logo", ""), ("image", "a.png", None, 1e4, 1.0, False, "", "few"), ("image", "a.png", None, 9e4, 1.0, False, "logo", "")]
    i = spark.createDataFrame(images, "kind string, src string, has boolean, area double, ratio double, edge boolean, words string, ctx string")
    got = [x.o for x in i.select(decisions.image_skip(*map(F.col, i.columns)).alias("o")).collect()]
    assert got == ["bbox_area", "not_image", "unsupported_mime", "image_file_missing", "aspect_ratio_small_area", "page_edge_small_image", "noise_keyword_small_image", "sparse_context_small_area", None]

"""Evidence, reports, captions, layouts and sources on small inline tables."""

import json

import pytest
from pyspark.sql import functions as F

from quarrylight.operators import captions, evaluation, evidence, layout
from quarrylight.sources import files


def test_evidence_against_documents(spark):
    docs = spark.createDataFrame([("a", "1"), ("b", "2")], "doc_id string, version string")
    read = spark.createDataFrame([("a", "1", "x"), ("a", "0", "x"), ("b", "2", " \n"), ("c", "1", "x"), ("b", "2", "y")], "doc_id string, version string, text string")
    assert sorted((r.doc_id, r.version, r.text, r.valid) for r in evidence.validated(read, docs).collect()) == [("a", "0", "x", False), ("a", "1", "x", True), ("b", "2", " \n", False), ("b", "2", "y", True), ("c", "1", "x", False)]
    scope = spark.createDataFrame([("a",)], "doc_id string")
    assert [r.doc_id for r in evidence.validated(read, docs, scope).where("valid").collect()] == ["a"]
    notes = spark.createDataFrame([(1, None, None), (2, "a", "1"), (2, "b", "1"), (3, "c", "1"), (3, "a", "0"), (4, "b", "2")], "note_id int, doc_id string, version string")
    assert {r.note_id: r.state for r in evidence.note_states(notes, docs).collect()} == {1: "unverified", 2: "stale", 3: "missing", 4: "current"}


def test_reads_reports_and_citations(spark):
    reads = spark.createDataFrame([(1, 0, "a", 1, "v", 10, 40), (1, 1, "a", 1, "v", 40, 70), (1, 2, "a", 1, "v", 41, 80), (1, 3, "a", 2, "v", 10, 20), (2, 4, "a", 1, "v", 12, 20)], "run_id int, seq int, doc_id string, page int, version string, start_line int, end_line int")
    kept = evidence.fresh_reads(reads)
    assert sorted(r.seq for r in kept.collect()) == [0, 2, 3, 4]
    assert sorted((r.run_id, r.seq, r.citation) for r in evidence.cited(kept).collect()) == [(1, 0, 1), (1, 2, 2), (1, 3, 3), (2, 4, 1)]
    schema = "run_id int, place int, question string, status string"
    before = spark.createDataFrame([(1, 0, "Why?", "partial"), (1, 1, "How?", "supported"), (2, 0, "Who?", "missing")], schema)
    after = spark.createDataFrame([(1, 0, " WHY? ", "supported"), (1, 1, "When?", "partial")] + [(2, k, f"q{k}", "partial") for k in range(8)], schema)
    assert [(r.place, r.question.strip(), r.status) for r in evidence.merged_reports(before, after).orderBy("run_id", "place").collect()] == [(0, "WHY?", "supported"), (1, "How?", "supported"), (2, "When?", "partial")]
    items = spark.createDataFrame([(1, "q", "supported", "none", "answer", "d"), (1, "r", "partial", "scope", "read", "d")], "run_id int, question string, status string, gap string, next_action string, detail string")
    blocked = spark.createDataFrame([(1, "r", "guide"), (3, None, "page 9")], "run_id int, question string, source string")
    assert sorted((r.run_id, r.question, r.status, r.gap) for r in evidence.with_blocked(items, blocked).collect()) == [(1, "q", "supported", "none"), (1, "r", "unsupported", "corpus_missing"), (3, "page 9", "unsupported", "corpus_missing")]


def test_captions_in_their_surroundings(spark):
    rows = [("d", 1, 0, "heading", "H", None), ("d", 1, 1, "text", "one two", None), ("d", 1, 2, "image", "", "a.png"), ("d", 1, 3, "text", "three", None), ("d", 1, 4, "text", "four five", None), ("d", 2, 5, "text", "other page", None), ("d", None, 6, "image", "", "b.png"), ("d", 10, 7, "text", "last", None)]
    elements = spark.createDataFrame(rows, "doc string, page int, index int, type string, content string, source string")
    got = {r["index"]: (r.context_before, r.context_after) for r in captions.with_context(elements, 9, 6).collect() if r.type == "image"}
    assert got == {2: ("H one two", "three..."), 6: ("other pa...", "last")}
    known = spark.createDataFrame([("d", 2, "i1", "A cat", 1, "a.png", "H", "b", ""), ("d", 6, "i2", "A dog", None, None, "", "", "")], "doc string, index int, image_id string, caption string, page int, path string, section_title string, context_before string, context_after string")
    assert {r["index"]: r.c for r in known.select("index", captions.separate_content().alias("c")).collect()} == {2: '[Image caption | page 1 | section "H"]\nA cat\nNearby text: before: b', 6: "[Image caption | page unknown]\nA dog"}
    pages = {r.page: r.text for r in captions.page_documents(captions.reading_units(elements, known)).collect()}
    assert pages["1"] == 'H\n\none two\n\n[Image id=i1 page=1 path=a.png section="H"] A cat\n\nthree\n\nfour five' and pages["unknown"] == "[Image id=i2 page=unknown path=unknown] A dog"
    plain = {r.page: r.text for r in captions.page_documents(captions.reading_units(elements)).collect()}
    assert set(plain) == {"1", "2", "10"} and plain["2"] == "other page"
    done, todo = captions.caption_join(elements.where("type = 'image'"), known.where("index = 2"))
    assert [r.image_id for r in done.collect()] == ["i1"] and [r["index"] for r in todo.collect()] == [6]
    chunks = captions.numbered(spark.createDataFrame([("d", "1", 1), ("d", "1", 0)], "doc string, page string, k int"), "text", ["page", "k"])
    assert {(r.k, r.chunk_id) for r in chunks.collect()} == {(0, "text-0001"), (1, "text-0002")}


def test_layouts(spark):
    nested = {"type": "Document", "kids": [{"type": "heading", "content": " A  b ", "page number": 1, "bounding box": [0, 1, 2, 3]}, {"kids": [{"type": "list", "list items": [{"type": "list item", "content": "x", "page": 2}]}]}, {"type": "table", "rows": [{"cells": [{"content": "c"}]}]}]}
    got = layout.flattened(spark.createDataFrame([("d", json.dumps(nested)), ("e", "no json"), ("f", None)], "doc string, layout string")).orderBy("index").collect()
    assert [(r.doc, r["index"], r.type, r.content, r.page) for r in got] == [("d", 0, "document", "", None), ("d", 1, "heading", "A b", 1), ("d", 2, "list", "", None), ("d", 3, "list item", "x", 2), ("d", 4, "table", "", None), ("d", 5, "", "c", None)]
    assert got[1].bbox == [0.0, 1.0, 2.0, 3.0]
    block = "text string, content string, table_body string, code_body string, equation string, image_caption array<string>, table_caption array<string>, chart_caption array<string>"
    rows = [(" t ", "c", None, None, None, None, None, None), (" ", None, "b", None, None, ["x"], None, None), (None, None, None, None, None, [" ", " one ", "two"], None, None), (None,) * 8]
    assert [r.t for r in spark.createDataFrame(rows, block).select(layout.block_text().alias("t")).collect()] == ["t", "b", "one\ntwo", ""]
    found = spark.createDataFrame([("d", "/r/x/other.md"), ("d", "/r/x/y/doc.md"), ("d", "/r/doc.md"), ("e", "/r/b.md"), ("e", "/r/a.md")], "doc string, path string")
    assert {r.doc: r.path for r in layout.chosen_artifacts(found, F.lit("doc")).collect()} == {"d": "/r/doc.md", "e": "/r/a.md"}
    assert {r.doc: r.path for r in layout.chosen_artifacts(found, F.lit("doc"), F.lit("/r/x")).collect()}["d"] == "/r/x/other.md"


def test_versioned_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "corpus"
    for name, data in (("v1/a.txt", "该进度计划的完整名称为北江计划。\r\n正文".encode()), ("v2/b.txt", b"\xef\xbb\xbf text "), ("v2/bad.txt", b"\xff\xfe"), ("v2/blank.txt", b" \n "), ("v2/skip.md", b"x")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    docs, errors = files.versioned_documents(spark, str(root))
    assert {(r.source, r.corpus_version, r.title, r.char_count) for r in docs.collect()} == {("v1/a.txt", "v1", "北江计划", 19), ("v2/b.txt", "v2", "b", 4)}
    assert {(r.source, r.reason) for r in errors.collect()} == {("v2/bad.txt", "not UTF-8"), ("v2/blank.txt", "empty")}
    assert [r.source for r in files.versioned_documents(spark, str(root), "v1")[0].collect()] == ["v1/a.txt"]
    files.write_json_lines(spark.createDataFrame([("1", "q", "a.txt", ["t"], None)], "id string, query string, expected_source string, expected_terms array<string>, expected_status string"), str(tmp_path / "cases"))
    assert tuple(files.eval_cases(spark, str(tmp_path / "cases")).first()) == ("1", "q", "a.txt", ["t"], None)
    (tmp_path / "bad.jsonl").write_text('{"id": "2", "query": " "}\n')
    with pytest.raises(Exception, match="needs a query"):
        files.eval_cases(spark, str(tmp_path / "bad.jsonl")).collect()
    spoken = spark.createDataFrame([("m", 1, 2.0, 3.5, "two"), ("m", 0, 0.0, 2.0, "one")], "media string, pos int, start double, end double, text string")
    row = files.transcripts(spoken).first()
    assert row.txt == "[00:00:00.00 - 00:00:02.00] one\n[00:00:02.00 - 00:00:03.50] two\n" and row.srt.startswith("1\n00:00:00,000 --> 00:00:02,000\none\n\n2\n") and "### 00:00:02.00 - 00:00:03.50\n\ntwo" in row.markdown


def test_evaluation_of_sources_and_evidence(spark):
    hits = spark.createDataFrame([(1, "x/a.txt", 1, ["p"]), (1, "x/b.txt", 2, ["q"]), (1, "x/b.txt", 3, ["r"]), (2, "x/a.txt", 1, ["q"])], "item_id int, source string, rank int, tokens array<string>")
    gold = spark.createDataFrame([(1, "x/b.txt"), (2, "x/b.txt")], "item_id int, gold string")
    terms = spark.createDataFrame([(1, "q"), (1, "r"), (2, "q")], "item_id int, term string")
    assert {r.item_id: (r.found, r.reciprocal, r.evidence) for r in evaluation.evidence_ranks(hits, gold, terms).collect()} == {1: (True, 0.5, True), 2: (False, 0.0, False)}
    ends = spark.createDataFrame([(1, "b.txt"), (2, "b.txt"), (3, "")], "item_id int, gold string")
    assert {r.item_id: r.hit for r in evaluation.source_hits(hits, ends, "item_id", "source").collect()} == {1: True, 2: False, 3: True}

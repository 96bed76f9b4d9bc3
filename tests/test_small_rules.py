"""Small rules: captions, pages taken in, catalogues, tokens, numbered lines, canonical JSON, chunk files."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quarrylight.functions.canonical import canonical_json, scalar_metadata, stable_hash
from quarrylight.functions.text import FEW_JOINERS, lexical_tokens, numbered
from quarrylight.operators import captions, decisions, web
from quarrylight.sources import files


def one(spark, column, *rows, kind="t string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], kind).select(column).collect()]


def test_caption_quality_names_what_is_wrong(spark):
    good = "A diagram of the network with three sites and their links."
    got = one(spark, decisions.caption_quality(F.col("t")), None, "  ", "short", good, "It is UNCLEAR what this is, I am unable to tell from it.")
    assert got[:4] == ["empty", "empty", "too_short(<40 chars)", ""]
    assert got[4].startswith("uncertainty_markers: ") and {"unclear", "unable to"} <= set(got[4].split(": ")[1].split(", "))
    assert one(spark, decisions.is_placeholder(F.col("t")), "DRY RUN CAPTION of 3", "caption", None) == [True, False, False]


def test_dry_runs_keep_stored_captions(spark):
    kind = "doc string, index int, caption string"
    made = spark.createDataFrame([("d", 1, "DRY RUN CAPTION 1"), ("d", 2, "DRY RUN CAPTION 2"), ("d", 3, "new")], kind)
    stored = spark.createDataFrame([("d", 1, "real"), ("d", 2, "DRY RUN CAPTION 2"), ("d", 3, "old"), ("d", 9, "gone")], kind)
    assert sorted(map(tuple, captions.persisted(made, stored, True).collect())) == [("d", 1, "real"), ("d", 2, "DRY RUN CAPTION 2"), ("d", 3, "new")]
    assert captions.persisted(made, stored, False).count() == 3


def test_pages_taken_in(spark):
    rows = [(1, "https://a.org/x", "text"), (2, "https://me:pw@a.org", "text"), (3, "ftp://a", "t"), (4, "http://b", " \n"), (5, "http://b", "x" * 11), (6, None, "t"), (7, "http://b", None), (8, "https://a.org/p@q", "t"), (9, "https://me@a.org/x", "t")]
    good, bad = web.taken_in(spark.createDataFrame(rows, "id int, url string, text string"), longest=10)
    assert sorted(r.id for r in good.collect()) == [1, 8]
    assert {r.id: r.reason for r in bad.collect()} == {2: "address with a user", 3: "no http address", 4: "empty", 5: "too long", 6: "no http address", 7: "empty", 9: "address with a user"}


def test_catalogues(spark):
    text = "[A](https://d.org/x/a.md) [B](https://d.org/x/b.md?q) [C](https://o.org/x/c.md) [D](http://d.org/x/d.md) [E](https://d.org/y/e.md) [F](https://d.org/x/f.html) [G](https://d.org/x/g.md) [A again](https://d.org/x/a.md)"
    got = web.catalogue(spark.createDataFrame([("s", text), ("t", None)], "section string, text string"), "d.org", "/x/").orderBy("place").collect()
    assert [(r.section, r.title, r.url) for r in got] == [("s", "A again", "https://d.org/x/a.md"), ("s", "G", "https://d.org/x/g.md")]


def test_tokens_with_fewer_joiners(spark):
    df = spark.createDataFrame([("c++ a+b x#y v1.2/3-4 数据",)], "t string")
    assert df.select(lexical_tokens(F.col("t"))).first()[0] == ["c", "a+b", "x#y", "v1.2/3-4", "数据"]
    assert df.select(lexical_tokens(F.col("t"), FEW_JOINERS)).first()[0] == ["c", "a", "b", "x", "y", "v1.2/3-4", "数据"]


def test_numbered_lines(spark):
    df = spark.createDataFrame([(["a", "", "b"], 7), ([], 1)], "l array<string>, n int")
    assert [r[0] for r in df.select(numbered(F.col("l"), F.col("n"))).collect()] == ["7: a\n8: \n9: b", ""]


def test_canonical_json(spark):
    value = {"b": [1, {"z": None, "a": 'q"\\'}], "a": "日本", "c": {"y": 1.5, "x": True}}
    texts = [json.dumps(value), json.dumps(dict(reversed(value.items())), indent=2), "{broken", None, "[2,  1]"]
    want = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    assert one(spark, canonical_json(F.col("t")), *texts) == [want, want, None, None, "[2,1]"]
    assert one(spark, stable_hash(F.col("t"), 24), texts[0]) == [hashlib.sha256(want.encode()).hexdigest()[:24]]
    assert one(spark, scalar_metadata(F.col("t")), texts[0], "[1]", '{"n": null, "i": 3}') == [json.dumps({"a": "日本", "b": '[1, {"a": "q\\"\\\\", "z": null}]', "c": '{"x": true, "y": 1.5}'}, ensure_ascii=False, separators=(",", ":")), None, '{"i":3}']


def test_document_ids_of_odd_file_names(spark, tmp_path):
    folder = tmp_path / "v1"
    folder.mkdir()
    (folder / 'a"b.txt').write_text("text")
    good, _ = files.versioned_documents(spark, str(tmp_path))
    row = good.first()
    told = json.dumps({"source": row.source, "source_sha256": hashlib.sha256(b"text").hexdigest()}, separators=(",", ":"))
    assert row.source == 'v1/a"b.txt' and row.document_id == "txt-" + hashlib.sha256(told.encode()).hexdigest()[:24]


def test_chunk_files(spark, tmp_path):
    rows = [{"id": "a", "chunk_type": "text", "source_pdf": "p.pdf", "page": 3, "text": "t", "metadata": {"chunk_id": "m", "page": 4, "extra": [1]}}, {"id": "b", "text": "u"}, {"id": "c", "text": ""}]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    got = {r.chunk_id: r for r in files.chunk_corpus(spark, str(tmp_path / "c.jsonl")).collect()}
    assert set(got) == {"m", "b"} and (got["m"].chunk_type, got["m"].source, got["m"].page, got["m"].text) == ("text", "p.pdf", 4, "t")
    assert json.loads(got["m"].metadata)["extra"] == [1] and got["b"].metadata is None and got["b"].page is None


def test_no_cases_are_an_error(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text("# none\n")
    with pytest.raises(ValueError, match="no evaluation cases"):
        files.eval_cases(spark, str(tmp_path / "e.jsonl"))


def test_slugs_and_headings(spark):
    from quarrylight.functions.text import headings, url_slug

    urls = ["https://a.org/x//y/?q=1&r#f", "https://a.org/", "http://é.org/ü b", "https:///", "https://a.org/" + "p" * 200, "https://a.org/._-"]
    assert one(spark, url_slug(F.col("t")), *urls) == ["a.org_x__y_q_1_r", "a.org", "é.org_ü_b", "page", ("a.org_" + "p" * 200)[:100], "a.org"]
    assert one(spark, headings(F.col("t")), "# A [l](u)\n## [only](u)\n# A\ntext\n#### D\n### C [x](y) z") == [["A", "C z"]]

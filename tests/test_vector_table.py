"""Vector tables: what a run embeds, what readers see, and what a run that dies leaves."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators.embedding import Embedder, hashing
from quarrylight.sources.vector_table import ContractMismatch, NoManifest, VectorTable, content_id


def texts(spark, rows):
    return spark.createDataFrame(rows, "id string, text string")


def actions(report):
    return {r.id: r.action for r in report.collect()}


def held(table):
    return {r.id: np.round(r.embedding, 12).tolist() for r in table.read().collect()}


@pytest.fixture
def table(spark, tmp_path):
    return VectorTable(spark, f"file://{tmp_path}/vectors", hashing(32))


def test_only_missing_texts_are_embedded(spark, table):
    assert actions(table.sync(texts(spark, [("a", "one text"), ("b", "two"), ("b", "two"), (None, "x"), ("e", None)]))) == {"a": "embedded", "b": "embedded", "e": "embedded"}
    assert actions(table.sync(texts(spark, [("b", "two"), ("c", "three")]))) == {"b": "reused", "c": "embedded", "a": "removed", "e": "removed"}
    want = hashing(32).encode(["two", "three"])
    assert held(table) == {"b": np.round(want[0], 12).tolist(), "c": np.round(want[1], 12).tolist()}
    told = table.manifest()
    assert told["version"] == 2 and told["collections"]["default"]["rows"] == 2


def test_a_second_run_embeds_nothing(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.write_text("")

    def encode(given):
        with calls.open("a") as f:
            f.write("x" * len(given))
        return np.ones((len(given), 2))

    t = VectorTable(spark, f"file://{tmp_path}/t", Embedder("counting", 2, {}, encode))
    rows = texts(spark, [(str(k), f"text {k}") for k in range(20)])
    t.sync(rows)
    assert len(calls.read_text()) == 20 and t.versions() == [1]
    assert set(actions(t.sync(rows)).values()) == {"reused"}
    assert len(calls.read_text()) == 20 and t.versions() == [1]


def test_a_run_that_dies_before_the_switch_leaves_the_old_version(spark, table, monkeypatch):
    table.sync(texts(spark, [("a", "one")]))
    before = held(table)
    with monkeypatch.context() as m:
        m.setattr(VectorTable, "_commit", lambda self, told: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            table.sync(texts(spark, [("b", "two")]))
    assert held(table) == before and table.versions() == [1]
    table.sync(texts(spark, [("b", "two")]))
    assert set(held(table)) == {"b"}
    gone = table.vacuum()
    assert len(gone) >= 3 and set(held(table)) == {"b"} and table.versions() == [2]


def test_of_two_runs_on_one_version_one_fails(spark, table):
    table.sync(texts(spark, [("a", "one")]))
    told = table.manifest()
    table.sync(texts(spark, [("a", "one"), ("b", "two")]))
    with pytest.raises(Exception, match="exist"):
        table._commit({**told, "version": 2})
    assert set(held(table)) == {"a", "b"}


def test_another_embedder_is_refused(spark, table):
    with pytest.raises(NoManifest):
        table.read()
    table.sync(texts(spark, [("a", "one")]))
    other = VectorTable(spark, table.path, hashing(64))
    for use in (other.read, lambda: other.sync(texts(spark, [("a", "one")]))):
        with pytest.raises(ContractMismatch):
            use()
    other.sync(texts(spark, [("a", "one")]), rebuild=True)
    assert len(other.read().first().embedding) == 64
    with pytest.raises(ContractMismatch):
        table.read()


def test_collections_share_a_manifest(spark, table):
    table.sync(texts(spark, [("a", "one")]))
    notes = VectorTable(spark, table.path, table.embedder, "notes")
    with pytest.raises(NoManifest):
        notes.read()
    notes.sync(texts(spark, [("n", "note")]))
    assert set(held(table)) == {"a"} and set(held(notes)) == {"n"}


def test_compaction_keeps_what_is_held(spark, table):
    for rows in ([("a", "one"), ("b", "two")], [("b", "two"), ("c", "three")], [("c", "three"), ("d", "four")]):
        table.sync(texts(spark, rows))
    before = held(table)
    table.compact()
    assert held(table) == before and len(table.manifest()["collections"]["default"]["data"]) == 1


def test_a_broken_manifest_is_an_error(spark, table, tmp_path):
    table.sync(texts(spark, [("a", "one")]))
    (tmp_path / "vectors/manifests/0000000002.json").write_text(json.dumps({"format": 9}))
    with pytest.raises(NoManifest):
        table.read()


def test_empty_tables(spark, table):
    table.sync(texts(spark, []))
    assert held(table) == {} and table.versions() == [1]
    table.sync(texts(spark, []))
    assert table.versions() == [1]


def test_content_ids_tell_parts_apart(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc")], "d string, t string")
    assert rows.select(content_id(F.col("t"), F.col("d")).alias("i")).distinct().count() == 4


def test_the_fingerprint_follows_the_contract():
    assert hashing(32).fingerprint() == hashing(32).fingerprint() != hashing(33).fingerprint()
    one = Embedder("m", 2, {"prompt": "a", "revision": "1"}, None)
    assert one.fingerprint() == Embedder("m", 2, {"revision": "1", "prompt": "a"}, None).fingerprint() != Embedder("m", 2, {"prompt": "b", "revision": "1"}, None).fingerprint()

"""The pipeline, stage by stage against the operators' own rules."""

import collections

import corpus_pipeline
from quarrylight.llm import packing, toxicity


def test_stages_in_order(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        rows = out.select("doc_id", "text", "n_chars").collect()
        kept = {r.doc_id for r in rows}
        assert kept <= ids and len(kept) == len(rows)
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            clean = [i for i in ids if labels.get(i) == 0]
            assert sum(i in kept for i in clean) > 0.97 * len(clean)
        if name == "exact_dedup":
            assert len({" ".join(r.text.split()) for r in rows}) == len(rows)
        if name == "pii":
            assert kept == ids and all(r.n_chars == len(r.text) for r in rows) and not any("@mail" in r.text for r in rows)
        docs, ids = spark.createDataFrame(out.collect(), out.schema), kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == ids
    fill = collections.Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY


def test_run_gives_packed_pieces(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert toxicity.held_out() is not None

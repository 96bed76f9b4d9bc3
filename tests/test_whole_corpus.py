"""Corpus queries over whole tables."""

from quarrylight.jobs import corpus


def test_index_sync_takes_all_documents(spark, tmp_path):
    spark.createDataFrame([(k, "t") for k in range(1, 8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2,), (3,), (3,), (9,)], "doc_id long").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((r.doc_id, r.action) for r in corpus.index_sync(spark, str(tmp_path)).collect())
    assert got == [(1, "add"), (4, "add"), (5, "add"), (6, "add"), (7, "add"), (9, "delete")]

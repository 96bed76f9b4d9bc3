"""Queries on vector tables and the whole product search.

Every benchmark passage is a query. A document's source stands for its title. A conversation is a note: its turns are the
body, it is reviewed if its last turn is odd, and it cites the document with its number and the next one, as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import word_tokens
from quarrylight.jobs import search as lexical_jobs
from quarrylight.jobs.corpus import _OLDER, _older, _t, _versions
from quarrylight.jobs.shared import folder
from quarrylight.operators import lexical, product
from quarrylight.operators.embedding import hashing
from quarrylight.sources.vector_table import VectorTable, content_id

K = 6


def vector_sync(spark: SparkSession, sf: str) -> DataFrame:
    """What a run over all documents embeds, keeps and removes in a table built over them as they were; how many places of each vector aren't zero."""
    table, docs = VectorTable(spark, folder(spark, "vector-table"), hashing()), _t(spark, sf, "documents")
    named = lambda d: d.select(content_id(F.col("text")).alias("id"), "text")
    table.sync(named(_older(docs)))
    report = table.sync(named(docs))
    filled = table.read().select("id", F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("places"))
    return report.join(filled, "id", "left")


def _notes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    turns = _t(spark, sf, "conversations")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    notes = turns.groupBy(F.col("conv_id").alias("note_id")).agg(body.alias("body"), (F.max("turn") % 2 == 1).alias("reviewed")).withColumn("title", F.lit("note"))
    cited = turns.select("conv_id").distinct().select(F.col("conv_id").alias("note_id"), F.posexplode(F.array(F.col("conv_id"), F.col("conv_id") + 1)).alias("nth", "doc_id"))
    return notes, cited.join(_versions(_older(_t(spark, sf, "documents"))).select("doc_id", "version"), "doc_id", "left").withColumn("start_line", F.lit(1).cast("long"))


def _searched(spark: SparkSession, sf: str, **kw) -> DataFrame:
    docs, queries = _t(spark, sf, "documents"), _t(spark, sf, "benchmark")
    terms = lexical.query_terms(queries, word_tokens(F.col("text")))
    locators = product.note_locators(*_notes(spark, sf), _versions(docs), terms, kw.get("scope"))
    found = product.search(docs, F.col("source"), queries, K, locators=locators, **kw)
    return found.withColumn("place", F.col("place").cast("long"))


def hybrid_product_search(spark: SparkSession, sf: str) -> DataFrame:
    """Product search over all documents: words and vectors fused, two windows of a document before the others, what notes cite in front."""
    return _searched(spark, sf, table=VectorTable(spark, folder(spark, "vector-table"), hashing()))


def scoped_product_search(spark: SparkSession, sf: str) -> DataFrame:
    """The same in a scope, the English documents: by words only, and only what notes cite there."""
    return _searched(spark, sf, table=VectorTable(spark, folder(spark, "vector-table"), hashing()), scope=_t(spark, sf, "documents").where("lang = 'en'"))


QUERIES = {f.__name__: f for f in (vector_sync, hybrid_product_search, scoped_product_search)}

_ID = "sha256(coalesce(length(text)::VARCHAR || ':' || text, '-'))"
_PLACES = r"SELECT DISTINCT {0}, ('0x' || substr(md5(t), 1, 8))::BIGINT % 256 AS place FROM (SELECT {0}, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+|[\x{{4e00}}-\x{{9fff}}]+')) AS t FROM {1})"
_COUNTED = _PLACES.replace("SELECT DISTINCT {0},", "SELECT {0},").replace(" AS place FROM", " AS place, count(*) AS c FROM") + " GROUP BY ALL"



def _noted(scope: str) -> str:
    """l(item_id, nth, doc_id): sources of notes for each passage; reads q(item_id, term) and the table all_docs."""
    return f"""nt AS (SELECT conv_id AS note_id, string_agg(text, chr(10) ORDER BY turn) AS body, max(turn) % 2 = 1 AS reviewed FROM conversations GROUP BY conv_id),
ns AS (SELECT note_id, unnest([0, 1]) AS nth, note_id + unnest([0, 1]) AS doc_id FROM nt),
nv AS (SELECT ns.*, d.text AS now, o.text AS old FROM ns LEFT JOIN all_docs d USING (doc_id) LEFT JOIN {_OLDER.replace("FROM documents", "FROM all_docs")} o USING (doc_id)),
ng AS (SELECT note_id FROM nv JOIN nt USING (note_id) GROUP BY note_id HAVING bool_and(reviewed) AND count(now) = count(*) AND count(*) FILTER (now <> old) = 0),
nw AS (SELECT DISTINCT note_id, unnest(regexp_extract_all(lower('note ' || body), '{lexical_jobs._W}')) AS term FROM nt JOIN ng USING (note_id)),
nm AS (SELECT DISTINCT item_id, note_id, nth, doc_id FROM q JOIN nw USING (term) JOIN nv USING (note_id) {scope}),
l AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY note_id, nth) AS k, doc_id FROM nm QUALIFY k <= 2)"""


_FRONT = f"""SELECT item_id, doc_id, start_line, row_number() OVER (PARTITION BY item_id ORDER BY noted DESC, pos) AS place, noted FROM (
  SELECT item_id, doc_id, 1 AS start_line, true AS noted, k AS pos FROM l UNION ALL SELECT item_id, doc_id, start_line, false, place FROM hits) QUALIFY place <= {K}"""
_SPLIT = "split_part(doc_id, ':', 1)::BIGINT AS d, split_part(doc_id, ':', 2)::BIGINT AS start_line"

ORACLES = {
    "vector_sync": f"""WITH o AS (SELECT DISTINCT {_ID} AS id FROM {_OLDER}), w AS (SELECT DISTINCT {_ID} AS id, text FROM documents),
p AS (SELECT id, count(*) AS places FROM ({_PLACES.format("id", "w")}) GROUP BY id)
SELECT coalesce(w.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'embedded' WHEN w.id IS NULL THEN 'removed' ELSE 'reused' END AS action, CASE WHEN w.id IS NOT NULL THEN coalesce(p.places, 0) END AS places
FROM o FULL JOIN w ON o.id = w.id LEFT JOIN p ON p.id = w.id""",
    "hybrid_product_search": f"""WITH all_docs AS (SELECT * FROM main.documents), {lexical_jobs._LINES.replace("FROM documents)", "FROM main.documents)")}, {lexical_jobs._bm25_sql(True)},
s1 AS ({lexical_jobs._ranked("", 20)}),
wb AS MATERIALIZED ({_COUNTED.format("doc_id", "documents")}), wn AS (SELECT doc_id, sum(c * c)::DOUBLE AS n FROM wb GROUP BY doc_id),
qb AS MATERIALIZED ({_COUNTED.format("item_id", "benchmark")}), qn AS (SELECT item_id, sum(c * c)::DOUBLE AS n FROM qb GROUP BY item_id),
dt AS (SELECT item_id, doc_id, sum(qb.c * wb.c)::DOUBLE AS dot FROM qb JOIN wb USING (place) GROUP BY ALL),
vs AS (SELECT qn.item_id, d.doc_id, coalesce(dot / sqrt(qn.n * wn.n), 0) AS score FROM qn CROSS JOIN documents d LEFT JOIN dt ON dt.item_id = qn.item_id AND dt.doc_id = d.doc_id LEFT JOIN wn ON wn.doc_id = d.doc_id),
s2 AS ({lexical_jobs._ranked("", 20, "vs")}),
fu AS (SELECT item_id, doc_id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (SELECT item_id, doc_id, rank FROM s1 UNION ALL SELECT item_id, doc_id, rank FROM s2) GROUP BY ALL),
fr AS (SELECT item_id, {_SPLIT}, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 12) DESC, doc_id) AS rank FROM fu QUALIFY rank <= {K}),
fn AS (SELECT *, row_number() OVER (PARTITION BY item_id, d ORDER BY rank) AS nth FROM fr),
hits AS (SELECT item_id, d AS doc_id, start_line, row_number() OVER (PARTITION BY item_id ORDER BY nth > 2, rank) AS place FROM fn),
{_noted("")} {_FRONT}""",
    "scoped_product_search": f"""WITH all_docs AS (SELECT * FROM main.documents), {lexical_jobs._LINES.replace("FROM documents)", "FROM main.documents WHERE lang = 'en')")}, {lexical_jobs._bm25_sql(True)},
e AS (SELECT item_id, {_SPLIT}, score, row_number() OVER (PARTITION BY item_id, split_part(doc_id, ':', 1) ORDER BY round(score, 6) DESC, doc_id) AS nth FROM s),
hits AS (SELECT item_id, d AS doc_id, start_line, row_number() OVER (PARTITION BY item_id ORDER BY nth > 2, round(score, 6) DESC, d, start_line) AS place FROM e QUALIFY place <= {K}),
{_noted("WHERE doc_id IN (SELECT doc_id FROM all_docs WHERE lang = 'en')")} {_FRONT}""",
}

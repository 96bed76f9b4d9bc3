"""Queries on evaluation runs, scopes and repeated searches.

Spanish documents stand for captions of images, all others for text chunks; a passage's gold chunk, and gold image if it is
a caption, is the document with its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import blank_tokens, word_tokens
from quarrylight.jobs import search as lexical_jobs
from quarrylight.jobs.shared import written
from quarrylight.operators import dense, experiments, fusion, lexical, repeated, scope

K = 6
ALPHAS = (0.3, 0.5, 0.7)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _retrieved(spark: SparkSession, sf: str, strategy: str, docs: DataFrame) -> DataFrame:
    """(strategy, retrieval, alpha, item_id, doc_id, rank): the dense ranking, and its fusion with words by each weight."""
    vectors = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    items = _t(spark, sf, "benchmark").select("item_id").join(vectors.select(F.col("vec_id").alias("item_id"), "embedding"), "item_id")
    held = vectors.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    near = dense.nearest(items, held, 20, query_col="item_id", include_self=True).select("item_id", F.col("vec_id").alias("doc_id"), F.col("cosine").alias("score"), "rank")
    tokens = lexical.with_tokens(docs.select("doc_id", "text"), blank_tokens(F.col("text"))).select("doc_id", "tokens")
    terms = lexical.query_terms(_t(spark, sf, "benchmark"), blank_tokens(F.col("text")))
    words = lexical.top_k(lexical.search(tokens, terms, False, 20), 20)
    runs = near.where(F.col("rank") <= K).select(F.lit("vector").alias("retrieval"), F.lit(1.0).alias("alpha"), "item_id", "doc_id", "rank")
    for alpha in ALPHAS:
        mixed = lexical.top_k(fusion.weighted(near, words, alpha, "item_id", "doc_id"), K)
        runs = runs.unionByName(mixed.select(F.lit("hybrid").alias("retrieval"), F.lit(alpha).alias("alpha"), "item_id", "doc_id", "rank"))
    return runs.withColumn("strategy", F.lit(strategy))


def experiment_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Each strategy (text chunks only; captions as chunks of their own) by each retrieval and weight: images in the evidence, size of the context, recall of gold."""
    docs = _t(spark, sf, "documents")
    is_caption = F.col("lang").eqNullSafe(F.lit("es"))
    hits = _retrieved(spark, sf, "text_only", docs.where(~is_caption)).unionByName(_retrieved(spark, sf, "separate_mixed", docs))
    number = F.col("doc_id").cast("string")
    chunks = docs.select("doc_id", number.alias("chunk_id"), F.when(is_caption, experiments.CAPTION).otherwise("text").alias("chunk_type"), F.when(is_caption, F.concat(F.lit("imgcap-"), number)).alias("image_id"), F.when(is_caption, F.concat(F.lit("img/"), number, F.lit(".png"))).alias("image_path"), (F.col("doc_id") % 10).cast("int").alias("page"), "text")
    hits = hits.join(chunks, "doc_id").withColumnRenamed("item_id", "case_id")
    items = _t(spark, sf, "benchmark").select(F.col("item_id").alias("case_id"))
    gold = items.join(docs.select(F.col("doc_id").alias("case_id"), is_caption.alias("c")), "case_id", "left")
    name = F.col("case_id").cast("string")
    cases = gold.select("case_id", F.when(F.col("c").isNotNull(), F.array(name)).alias("gold_chunk_ids"), F.when(F.coalesce("c", F.lit(False)), F.array(F.concat(F.lit("imgcap-"), name))).alias("gold_image_ids"))
    variants = spark.createDataFrame([(s, r, a) for s in ("text_only", "separate_mixed") for r, a in (("vector", 1.0), *(("hybrid", a) for a in ALPHAS))], "strategy string, retrieval string, alpha double")
    return experiments.matrix(experiments.run_metrics(items.crossJoin(F.broadcast(variants)), hits, cases))


def scope_binding(spark: SparkSession, sf: str) -> DataFrame:
    """A question about every labelled document, which it names by id, source, origin, a text that names none, or not at all."""
    docs = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("title"), F.concat(F.lit("file-"), F.col("doc_id").cast("string")).alias("origin"))
    asked = _t(spark, sf, "labels").select("doc_id").distinct().join(_t(spark, sf, "documents").select("doc_id", "source"), "doc_id", "left")
    number = F.col("doc_id").cast("string")
    way, allow = F.pmod(F.col("doc_id"), F.lit(5)), F.pmod(F.floor(F.col("doc_id") / 5), F.lit(4))
    reference = F.when(way == 0, number).when(way == 1, F.col("source")).when(way == 2, F.concat(F.lit("file-"), number)).when(way == 3, F.concat(F.lit("lost-"), number))
    allowed = F.when(allow == 1, F.array(number)).when(allow == 2, F.array(number, F.lit("gone"))).when(allow == 3, F.array(F.lit("0")))
    questions = asked.select(number.alias("question_id"), reference.alias("reference"), allowed.alias("allowed_doc_ids"), (F.pmod(F.col("doc_id"), F.lit(7)) > 0).alias("needs_scope"), F.when(F.pmod(F.col("doc_id"), F.lit(11)) > 0, F.upper(F.concat(F.lit("what does "), reference, F.lit(" say")))).alias("user_text"))
    return scope.bind(questions, docs).select("question_id", "stop_reason", F.array_join("bound_doc_ids", ",").alias("bound"))


def search_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of a user as a search, two different ones a conversation: refused, answered before, and the first document found."""
    said = _t(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    questions = repeated.budgeted(said, 2, "conv_id", "turn").select("conv_id", "turn", "key", "refused", "cached")

    def search(queries: DataFrame) -> DataFrame:
        tokens = written(lexical.with_tokens(_t(spark, sf, "documents"), word_tokens(F.col("text"))).select("doc_id", "tokens"), "tokens")  # read in two passes for each part of the questions
        terms = lexical.query_terms(queries, word_tokens(F.col("text")), "key")
        return lexical.top_k(lexical.search(tokens, terms, True, 1, query_col="key"), 1, query_col="key").select("key", "doc_id")

    return repeated.answered(questions, search).select("conv_id", "turn", "refused", "cached", "doc_id")


QUERIES = {f.__name__: f for f in (experiment_matrix, scope_binding, search_budget)}


def _strategy_sql(name: str, where: str) -> str:
    """The hits of a strategy, over the documents that it holds."""
    ranked = lambda k, s: lexical_jobs._ranked("", k, s)
    near = lexical_jobs._ITEM.replace("CROSS JOIN u b)", "CROSS JOIN u b WHERE b.vec_id IN (SELECT doc_id FROM documents))")
    mixed = " UNION ALL ".join(f"SELECT 'hybrid' AS retrieval, {a}::DOUBLE AS alpha, item_id, doc_id, rank FROM ({ranked(K, f'f{n}')})" for n, a in enumerate(ALPHAS))
    parts = ", ".join(f"f{n} AS ({lexical_jobs._fused(f'{a}::DOUBLE')})" for n, a in enumerate(ALPHAS))
    return f"""SELECT '{name}' AS strategy, * FROM (WITH documents AS (SELECT * FROM main.documents {where}), {lexical_jobs._bm25_sql(False, words=False)}, {near}, l AS ({ranked(20, "s")}), {parts}
  SELECT 'vector' AS retrieval, 1.0::DOUBLE AS alpha, item_id, doc_id, rank FROM d WHERE rank <= {K} UNION ALL {mixed})"""


ORACLES = {
    "experiment_matrix": f"""WITH h AS ({_strategy_sql("text_only", "WHERE lang IS DISTINCT FROM 'es'")} UNION ALL {_strategy_sql("separate_mixed", "")}),
v AS (SELECT * FROM (VALUES ('text_only'), ('separate_mixed')) s(strategy), (VALUES ('vector', 1.0::DOUBLE), ('hybrid', 0.3::DOUBLE), ('hybrid', 0.5::DOUBLE), ('hybrid', 0.7::DOUBLE)) r(retrieval, alpha), (SELECT item_id FROM benchmark)),
b AS (SELECT h.*, lang IS NOT DISTINCT FROM 'es' AS cap, regexp_extract_all(text, '\\[Image\\s+id=(imgcap-\\d+)', 1) AS inl, length(CASE WHEN lang IS NOT DISTINCT FROM 'es' THEN '[Image evidence #' || rank || '] id=imgcap-' || doc_id || ' page=' || doc_id % 10 || ' path=img/' || doc_id || '.png'
  ELSE '[Text evidence #' || rank || '] id=' || doc_id || ' page=' || doc_id % 10 END || chr(10) || text) + 2 AS n FROM h JOIN documents USING (doc_id)),
m AS (SELECT v.strategy, v.retrieval, v.alpha, v.item_id, count(b.doc_id) AS hits, count(*) FILTER (cap) AS images, coalesce(sum(len(inl)), 0) AS inlined, coalesce(sum(n) - 2, 23) AS chars, coalesce(bool_or(b.doc_id = v.item_id), false) AS hit
  FROM v LEFT JOIN b USING (strategy, retrieval, alpha, item_id) GROUP BY ALL),
g AS (SELECT m.*, d.doc_id IS NOT NULL AS has, coalesce(d.lang = 'es', false) AS image FROM m LEFT JOIN documents d ON d.doc_id = m.item_id)
SELECT strategy, retrieval, alpha, count(*) AS runs, count(DISTINCT item_id) AS cases, round(avg(images), 4) AS avg_image_evidence_count, round(avg(inlined), 4) AS avg_inline_image_mention_count, round(avg(images + inlined), 4) AS avg_image_reference_count,
round(avg(chars), 2) AS avg_context_chars, round(avg(hit::INT) FILTER (image), 4) AS gold_image_recall_at_k, round(avg(hit::INT) FILTER (has), 4) AS gold_chunk_recall_at_k FROM g GROUP BY ALL""",
    "scope_binding": """WITH a AS (SELECT DISTINCT l.doc_id, d.source, l.doc_id::VARCHAR AS n, l.doc_id % 5 AS way, l.doc_id // 5 % 4 AS allow FROM labels l LEFT JOIN documents d USING (doc_id)),
q AS (SELECT *, CASE way WHEN 0 THEN n WHEN 1 THEN source WHEN 2 THEN 'file-' || n WHEN 3 THEN 'lost-' || n END AS ref, CASE allow WHEN 1 THEN [n] WHEN 2 THEN [n, 'gone'] WHEN 3 THEN ['0'] END AS ok, doc_id % 7 > 0 AS needs, doc_id % 11 > 0 AS said FROM a),
m AS (SELECT q.*, (SELECT count(*) FROM documents d WHERE q.ref IN (d.doc_id::VARCHAR, d.source, 'file-' || d.doc_id)) AS k, (SELECT min(d.doc_id::VARCHAR) FROM documents d WHERE q.ref IN (d.doc_id::VARCHAR, d.source, 'file-' || d.doc_id)) AS hit,
  ok IS NOT NULL AND (allow = 2 OR NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id::VARCHAR = ok[1])) AS lacks FROM q),
r AS (SELECT *, CASE WHEN lacks THEN 'scope_missing' WHEN NOT needs THEN NULL WHEN ref IS NOT NULL AND NOT said THEN 'scope_ambiguous' WHEN ref IS NOT NULL AND k = 0 THEN 'scope_missing' WHEN ref IS NOT NULL AND k > 1 THEN 'scope_ambiguous'
  WHEN ref IS NULL AND ok IS NULL THEN 'scope_ambiguous' WHEN ref IS NOT NULL AND ok IS NOT NULL AND NOT list_contains(ok, hit) THEN 'scope_conflict' END AS stop_reason FROM m)
SELECT n AS question_id, stop_reason, CASE WHEN stop_reason IS NULL AND needs AND ref IS NOT NULL THEN hit ELSE array_to_string(ok, ',') END AS bound FROM r""",
    "search_budget": f"""WITH u AS (SELECT conv_id, turn, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS key FROM conversations WHERE role = 'user'),
f AS (SELECT conv_id, key, min(turn) AS first, row_number() OVER (PARTITION BY conv_id ORDER BY min(turn), key) AS nth FROM u GROUP BY conv_id, key),
y AS (SELECT conv_id, turn, key, nth > 2 AS refused, nth <= 2 AND turn > first AS cached FROM u JOIN f USING (conv_id, key)),
benchmark AS (SELECT DISTINCT key AS item_id, key AS text FROM y WHERE NOT refused), {lexical_jobs._bm25_sql(True)}, k AS ({lexical_jobs._ranked("", 1)})
SELECT conv_id, turn, refused, cached, CASE WHEN NOT refused THEN doc_id END AS doc_id FROM y LEFT JOIN k ON k.item_id = y.key""",
}

"""Search queries: lexical, dense and fused rankings of benchmark passages against documents and of vectors against vectors.

All tokens of a passage are its query; every passage is a query, every document and vector is searched. Where
dense and lexical rankings meet, a passage takes the vector with its number as its own and a vector stands for the
document with its number: the tables share no other key. A document's source stands for its title, and of pages the
html title and address describe them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrylight.functions.text import blank_tokens, bounded_lines, clean, folded, lexical_tokens, windowed_tokens, word_tokens
from quarrylight.jobs.shared import written
from quarrylight.operators import dense, evaluation, fusion, lexical, vector_index, web

K = 6


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _tokens(docs: DataFrame, tokens=word_tokens) -> DataFrame:
    return lexical.with_tokens(docs, tokens(F.col("text")))


def _asked(spark: SparkSession, sf: str, tokens=word_tokens) -> DataFrame:
    return lexical.query_terms(_t(spark, sf, "benchmark"), tokens(F.col("text")))


def _best(spark: SparkSession, sf: str, k: int, plus: bool = True, docs: DataFrame | None = None, tokens=word_tokens, allowed_col: str | None = None) -> DataFrame:
    """The k best documents of each passage: (item_id, doc_id, score, rank)."""
    docs = _tokens(_t(spark, sf, "documents") if docs is None else docs, tokens)
    return lexical.top_k(lexical.search(docs, _asked(spark, sf, tokens), plus, k, allowed_col=allowed_col), k)


def _shown(ranked: DataFrame) -> DataFrame:
    return ranked.select("item_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def product_search(spark: SparkSession, sf: str) -> DataFrame:
    """Line windows, led by the title, by BM25; at most two of a document before the others, best window first."""
    docs = _t(spark, sf, "documents").select("doc_id", "source", F.explode(windowed_tokens(bounded_lines(F.col("text")))).alias("w")).where("w.lettered")
    windows = docs.select("doc_id", F.col("w.start_line").cast("long").alias("start_line"), F.concat(word_tokens(F.col("source")), F.col("w.tokens")).alias("t"))
    found = lexical.search(lexical.with_tokens(windows, F.col("t")), _asked(spark, sf), True, 2 + K, id_cols=("doc_id", "start_line"), group_col="doc_id")
    out = lexical.diverse_top(found, "doc_id", 2, K, id_cols=("doc_id", "start_line"))
    return out.select("item_id", "doc_id", "start_line", F.col("place").cast("long").alias("place"), F.round("score", 6).alias("score"))


def bm25_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Document and corpus frequency of every term."""
    return lexical.term_counts(_tokens(_t(spark, sf, "documents")))


def bm25_plus_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The best documents of each passage by BM25 with a floor for terms that a document lacks."""
    return _shown(_best(spark, sf, K))


def bm25_okapi_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The best documents by plain BM25 on tokens between blanks."""
    return _shown(_best(spark, sf, K, plus=False, tokens=blank_tokens))


def scoped_bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The scope filters before statistics are taken."""
    return _shown(_best(spark, sf, K, docs=_t(spark, sf, "documents").where("lang = 'en'")))


def routed_bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The route filters after scoring with the statistics of the whole corpus."""
    docs = _t(spark, sf, "documents").withColumn("may", F.coalesce(F.col("lang") == "en", F.lit(False)))
    return _shown(_best(spark, sf, K, docs=docs, allowed_col="may"))


def diversified_topk(spark: SparkSession, sf: str) -> DataFrame:
    """At most two documents of a source before the others."""
    found = lexical.search(_tokens(_t(spark, sf, "documents")), _asked(spark, sf), True, 2 + K, group_col="source")
    return lexical.diverse_top(found, "source", 2, K).select("item_id", "doc_id", "source", F.col("place").cast("long").alias("place"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as documents: title and address describe them, title and plain body are searched; tokens with inner joiners."""
    html = F.col("html")
    pages = _t(spark, sf, "pages").select("page_id", "url", clean(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), web.plain(html).alias("body"))
    both = pages.select("page_id", folded(F.concat_ws(" ", "title", "url")).alias("d"), folded(F.concat_ws("\n", "title", "body")).alias("b"))
    return both.select("page_id", lexical_tokens(F.col("d")).alias("descriptor"), lexical_tokens(F.col("b")).alias("t"))


def _folded_queries(spark: SparkSession, sf: str) -> DataFrame:
    texts = _t(spark, sf, "benchmark").select("item_id", folded(F.col("text")).alias("text"))
    return lexical.query_terms(texts, lexical_tokens(F.col("text")))


def _routes(spark: SparkSession, sf: str, pages: DataFrame | None = None) -> DataFrame:
    descriptors = (_pages(spark, sf) if pages is None else pages).select("page_id", F.explode(F.array_distinct("descriptor")).alias("term"))
    return lexical.router(descriptors, _folded_queries(spark, sf), group_col="page_id")


def doc_router(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that a passage names by distinctive words of their titles and addresses."""
    return _routes(spark, sf).select("item_id", "page_id", F.round("score", 6).alias("score"))


def _read_once(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(pages, routes) as tables: html is read and cut into tokens once, passages are routed once, however many passes follow."""
    pages = written(_pages(spark, sf), "pages")
    return pages, written(_routes(spark, sf, pages).select("item_id", "page_id"), "routes")


def _routed_lexical(spark: SparkSession, sf: str, k: int, pages: DataFrame, routes: DataFrame) -> DataFrame:
    """The k best pages of each passage among those it is routed to, or all; then positive scores only."""
    docs = lexical.with_tokens(pages, F.col("t"))
    found = lexical.search(docs, _folded_queries(spark, sf), False, k, id_cols=("page_id",), routes=routes)
    return lexical.top_k(found, k, id_col="page_id").where(F.round("score", 6) > 0)


def lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    """Routed lexical search of pages by words with inner joiners; documents without a positive score go after the cut."""
    return _routed_lexical(spark, sf, K, *_read_once(spark, sf)).select("item_id", "page_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def routed_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """Dense and lexical rankings of routed pages, fused by weighted reciprocal ranks; with each branch's rank and score."""
    pages, routes = _read_once(spark, sf)
    asked = routes.select("item_id").distinct().withColumn("routed", F.lit(True))
    v = _vectors(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    items = _t(spark, sf, "benchmark").select("item_id").join(v.select(F.col("vec_id").alias("item_id"), "embedding"), "item_id")
    paged = v.join(_t(spark, sf, "pages").select(F.col("page_id").alias("vec_id")), "vec_id", "left_semi")
    free = dense.nearest(items.join(asked, "item_id", "left_anti"), paged, 20, query_col="item_id", include_self=True).select("item_id", F.col("vec_id").alias("page_id"), F.col("cosine").alias("score"))
    pairs = routes.join(items, "item_id").join(paged.select(F.col("vec_id").alias("page_id"), F.col("embedding").alias("other")), "page_id")
    near = pairs.select("item_id", "page_id", dense.cosine(F.col("embedding"), F.col("other")).alias("score")).unionByName(free)
    dense_20 = lexical.top_k(near, 20, id_col="page_id")
    return _branches(dense_20, _routed_lexical(spark, sf, 20, pages, routes), 0.4, 4).join(asked, "item_id", "left").select("*", F.coalesce("routed", F.lit(False)).alias("metadata_routed")).drop("routed")


def _branches(dense_20: DataFrame, lexical_20: DataFrame, weight: float, k: int) -> DataFrame:
    side = lambda df, name: df.select("item_id", "page_id", F.col("rank").cast("long").alias(f"{name}_rank"), F.round("score", 6).alias(f"{name}_score"))
    both = side(dense_20, "dense").join(side(lexical_20, "lexical"), ["item_id", "page_id"], "full")
    part = lambda w, c: F.coalesce(F.lit(w) / (fusion.RANK_OFFSET + F.col(c)), F.lit(0.0))
    scored = both.withColumn("score", part(weight, "dense_rank") + part(1 - weight, "lexical_rank"))
    return lexical.top_k(scored, k, id_col="page_id").withColumn("rank", F.col("rank").cast("long")).withColumn("score", F.round("score", 6))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def _fiftieth(vectors: DataFrame) -> DataFrame:
    return vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five vectors nearest to every fiftieth."""
    v = _vectors(spark, sf)
    return dense.nearest(_fiftieth(v), v, 5).select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("cosine", 6).alias("cosine"))


def ann_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The same by an inverted-file index over all vectors, which looks at as many lists as hold 0.95 of a sample's neighbours."""
    v = _vectors(spark, sf)
    found = vector_index.build(v).search(_fiftieth(v), 5)
    return found.select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("cosine", 6).alias("cosine"))


def dense_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Of the eight nearest, those of a least similarity."""
    v = _vectors(spark, sf)
    return dense.nearest(_fiftieth(v), v, 8).where(F.round("cosine", 6) >= 0.35).select("query_id", "vec_id", F.round("cosine", 6).alias("cosine"))


def dense_label_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a hit within 5 has the query's label, and the reciprocal rank of the first one; averages by label."""
    v = _vectors(spark, sf)
    labels = v.select("vec_id", "label")
    hits = dense.nearest(_fiftieth(v), v, 5).join(labels, "vec_id")
    gold = labels.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("gold"))
    ranks = evaluation.source_ranks(hits, gold, "query_id", "label")
    return evaluation.summary(ranks.join(gold, "query_id"), ["gold"])


def mmr_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Four of the sixteen nearest, chosen to be near the query and apart from one another."""
    v = _vectors(spark, sf)
    return dense.diverse(dense.nearest(_fiftieth(v), v, 16), v)


def _item_dense(spark: SparkSession, sf: str, k: int) -> DataFrame:
    v = _vectors(spark, sf)
    items = _t(spark, sf, "benchmark").select("item_id").join(v.select(F.col("vec_id").alias("item_id"), "embedding"), "item_id")
    near = dense.nearest(items, v, k, query_col="item_id", include_self=True)
    return near.select("item_id", F.col("vec_id").alias("doc_id"), F.col("cosine").alias("score"), "rank")


def rrf_equal(spark: SparkSession, sf: str) -> DataFrame:
    """Both rankings fused by reciprocal ranks of equal weight."""
    rankings = [(_item_dense(spark, sf, 20), 1.0), (_best(spark, sf, 20), 1.0)]
    return _shown(lexical.top_k(fusion.reciprocal_ranks(rankings, "item_id", "doc_id"), K))


def rrf_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """The same with weights."""
    rankings = [(_item_dense(spark, sf, 20), 0.4), (_best(spark, sf, 20), 0.6)]
    return _shown(lexical.top_k(fusion.reciprocal_ranks(rankings, "item_id", "doc_id"), 4))


def alpha_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of both sides, normalised and weighted."""
    fused = fusion.weighted(_item_dense(spark, sf, 20), _best(spark, sf, 20, plus=False, tokens=blank_tokens), 0.7, "item_id", "doc_id")
    return _shown(lexical.top_k(fused, K))


def experiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Number of hits, share of those labelled good, and mean score, for each weight of the dense side."""
    d, x = _item_dense(spark, sf, 20), _best(spark, sf, 20)
    labels = _t(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    runs = None
    for alpha in (0.3, 0.5, 0.7, 1.0):
        run = lexical.top_k(fusion.weighted(d, x, alpha, "item_id", "doc_id"), K).withColumn("alpha", F.lit(alpha))
        runs = run if runs is None else runs.unionByName(run)
    judged = runs.join(labels, "doc_id", "left")
    return judged.groupBy("alpha").agg(F.count("*").alias("hits"), F.count("quality").alias("judged"), F.round(F.avg("quality"), 6).alias("good_share"), F.round(F.avg(F.round("score", 6)), 5).alias("mean_score"))


def eval_term_hit(spark: SparkSession, sf: str) -> DataFrame:
    """Whether one of the first four documents has all terms of the query."""
    kept = _tokens(_t(spark, sf, "documents"))
    hits = _best(spark, sf, 4).join(kept.select("doc_id", "tokens"), "doc_id")
    return evaluation.term_hits(hits, _asked(spark, sf).select("item_id", "term"))


def evidence_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Of the best documents of each passage: how often one is of the source of the document with its number, and has, with others of that source, all of the passage's terms."""
    docs = _t(spark, sf, "documents")
    hits = _best(spark, sf, K).join(_tokens(docs).select("doc_id", "source", "tokens"), "doc_id")
    asked = _asked(spark, sf).select("item_id", "term")
    gold = _t(spark, sf, "benchmark").select("item_id").join(docs.select(F.col("doc_id").alias("item_id"), F.col("source").alias("gold")), "item_id")
    ranks = evaluation.evidence_ranks(hits, gold, asked)
    share = lambda c: F.round(F.avg(F.col(c).cast("double")), 6)
    return ranks.agg(F.count("*").alias("cases"), share("found").alias("source_recall"), share("evidence").alias("evidence_recall"), share("reciprocal").alias("mrr"))


_W = r"[a-z0-9_]+|[\x{4e00}-\x{9fff}]+"


def _bm25_sql(plus: bool, where: str = "", words: bool = True, tok: str = "") -> str:
    """Common table expressions up to s(item_id, doc_id, score)."""
    tok = tok or f"regexp_extract_all(lower(text), '{_W}')" if words else tok or r"list_filter(string_split_regex(lower(text), '\s+'), lambda t: t <> '')"
    idf = "ln((n + 1) / df)" if plus else "CASE WHEN ln(n - df + 0.5) - ln(df + 0.5) < 0 THEN 0.25 * avg(ln(n - df + 0.5) - ln(df + 0.5)) OVER () ELSE ln(n - df + 0.5) - ln(df + 0.5) END"
    base = " + (SELECT sum(qf * idf) FROM a WHERE a.item_id = x.item_id)" if plus else ""
    return f"""
t AS (SELECT doc_id, CASE WHEN len({tok}) > 0 THEN {tok} ELSE ['_empty_'] END AS tokens FROM documents {where}),
p AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM t) GROUP BY ALL),
z AS (SELECT count(*)::DOUBLE AS n, avg(len(tokens)::DOUBLE) AS avgdl FROM t),
i AS (SELECT term, avgdl, {idf} AS idf FROM (SELECT term, count(*) AS df FROM p GROUP BY term), z),
q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest({tok}) AS term FROM benchmark) GROUP BY ALL),
a AS (SELECT item_id, term, qf, idf, avgdl FROM q JOIN i USING (term)),
x AS (SELECT item_id, doc_id, sum(qf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM p JOIN a USING (term) GROUP BY item_id, doc_id),
s AS (SELECT item_id, doc_id, score{base} AS score FROM x)"""


def _ranked(cte: str, k: int, name: str = "s") -> str:
    return f"SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank, score FROM {name} QUALIFY rank <= {k}"


def _top_sql(cte: str, k: int = K, name: str = "s") -> str:
    return f"WITH {cte} SELECT item_id, doc_id, rank, round(score, 6) AS score FROM ({_ranked(cte, k, name)})"


_UNIT = "SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings"
_NEAR = f"u AS ({_UNIT}), c AS (SELECT a.vec_id AS query_id, b.vec_id, a.label AS gold, b.label, list_dot_product(a.v, b.v) / (a.n * b.n) AS cosine FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, vec_id) AS rank FROM c)"
_ITEM = f"u AS ({_UNIT}), c AS (SELECT a.vec_id AS item_id, b.vec_id AS doc_id, list_dot_product(a.v, b.v) / (a.n * b.n) AS score FROM u a JOIN benchmark ON item_id = a.vec_id CROSS JOIN u b), d AS ({_ranked('', 20, 'c')})"


def _rrf_sql(w1: float, w2: float, k: int) -> str:
    cte = f"{_bm25_sql(True)}, {_ITEM}, l AS ({_ranked('', 20)}), f AS (SELECT item_id, doc_id, sum(w) AS score FROM (SELECT item_id, doc_id, {w1}::DOUBLE / (60 + rank) AS w FROM d UNION ALL SELECT item_id, doc_id, {w2}::DOUBLE / (60 + rank) FROM l) GROUP BY ALL)"
    return _top_sql(cte, k, "f")


def _norm(name: str) -> str:
    w = "(PARTITION BY item_id)"
    return f"SELECT item_id, doc_id, CASE WHEN max(score) OVER {w} = min(score) OVER {w} THEN 1.0::DOUBLE ELSE (score - min(score) OVER {w}) / (max(score) OVER {w} - min(score) OVER {w}) END AS v FROM {name}"


def _fused(alpha: str) -> str:
    return f"SELECT item_id, doc_id, {alpha} * coalesce(a.v, 0) + (1 - {alpha}) * coalesce(b.v, 0) AS score FROM ({_norm('d')}) a FULL JOIN ({_norm('l')}) b USING (item_id, doc_id)"


QUERIES = {f.__name__: f for f in (product_search, bm25_stats, bm25_plus_topk, bm25_okapi_topk, scoped_bm25_topk, routed_bm25_topk, diversified_topk, doc_router, lexical_search, routed_fusion, dense_topk, ann_topk, dense_threshold, dense_label_recall, mmr_topk, rrf_equal, rrf_weighted, alpha_fusion, experiment_summary, eval_term_hit, evidence_recall)}

_LINES = r"""b0 AS (SELECT doc_id, source, CASE WHEN text = '' THEN [] WHEN l[-1] = '' THEN l[:-2] ELSE l END AS l FROM (SELECT doc_id, source, text, string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS l FROM documents)),
b AS (SELECT doc_id, source, flatten(list_transform(l, lambda s: list_transform(range(0, greatest(len(s), 1), 300), lambda k: substr(s, k + 1, 300)))) AS l FROM b0),
w AS (SELECT doc_id, source, st + 1 AS start_line, array_to_string(list_slice(l, st + 1, st + 24), chr(10)) AS text FROM (SELECT doc_id, source, l, unnest(range(0, len(l), 16)) AS st FROM b)),
documents AS (SELECT printf('%012d', doc_id) || ':' || printf('%09d', start_line) AS doc_id, source || ' ' || text AS text FROM w WHERE regexp_matches(text, '[A-Za-z\x{4e00}-\x{9fff}]'))"""

#: Pages routed to: o(item_id, page_id, score); and their okapi scores after routing: g(item_id, doc_id, score).
_T3 = r"regexp_extract_all(replace(lower({}), 'ß', 'ss'), '[a-z0-9]+(?:[._+#/-][a-z0-9]+)*|[\x{{3400}}-\x{{9fff}}]+')"
_ROUTED = rf"""pg AS (SELECT page_id, url, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title,
trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM pages),
ds AS (SELECT DISTINCT page_id, unnest({_T3.format("title || ' ' || url")}) AS term FROM pg),
nn AS (SELECT count(DISTINCT page_id) AS n FROM ds), f AS (SELECT term, ln((n + 1) / (count(*) + 1)::DOUBLE) + 1 AS w FROM ds, nn GROUP BY term, n HAVING n >= 2 AND count(*) <= greatest(1, n // 3)),
dq AS (SELECT DISTINCT item_id, unnest({_T3.format("text")}) AS term FROM benchmark),
h AS (SELECT item_id, page_id, sum(w) AS score FROM dq JOIN f USING (term) JOIN ds USING (term) GROUP BY ALL),
o AS (SELECT * FROM h QUALIFY max(score) OVER (PARTITION BY item_id) > 0 AND round(score, 6) >= round(0.8::DOUBLE * max(score) OVER (PARTITION BY item_id), 6))"""
_PAGES_BM25 = f"""t AS (SELECT page_id AS doc_id, {_T3.format("title || chr(10) || body")} AS tokens FROM pg),
{_bm25_sql(False, tok=_T3.format("text")).split("FROM documents ),", 1)[1]},
g AS (SELECT s.* FROM s WHERE item_id NOT IN (SELECT item_id FROM o) OR (item_id, doc_id) IN (SELECT (item_id, page_id) FROM o))"""

ORACLES = {
    "product_search": f"WITH {_LINES}, {_bm25_sql(True)}, e AS (SELECT item_id, split_part(doc_id, ':', 1)::BIGINT AS d, split_part(doc_id, ':', 2)::BIGINT AS start_line, score, row_number() OVER (PARTITION BY item_id, split_part(doc_id, ':', 1) ORDER BY round(score, 6) DESC, doc_id) AS nth FROM s) "
    f"SELECT item_id, d AS doc_id, start_line, row_number() OVER (PARTITION BY item_id ORDER BY nth > 2, round(score, 6) DESC, d, start_line) AS place, round(score, 6) AS score FROM e QUALIFY place <= {K}",
    "bm25_stats": f"WITH {_bm25_sql(True)} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY term",
    "bm25_plus_topk": _top_sql(_bm25_sql(True)),
    "bm25_okapi_topk": _top_sql(_bm25_sql(False, words=False)),
    "scoped_bm25_topk": _top_sql(_bm25_sql(True, "WHERE lang = 'en'")),
    "routed_bm25_topk": _top_sql(_bm25_sql(True) + ", o AS (SELECT * FROM s WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en'))", name="o"),
    "diversified_topk": f"WITH {_bm25_sql(True)}, e AS (SELECT s.*, source, row_number() OVER (PARTITION BY item_id, source ORDER BY round(score, 6) DESC, doc_id) AS nth FROM s JOIN documents USING (doc_id)) SELECT item_id, doc_id, source, row_number() OVER (PARTITION BY item_id ORDER BY nth > 2, round(score, 6) DESC, doc_id) AS place FROM e QUALIFY place <= {K}",
    "doc_router": f"WITH {_ROUTED} SELECT item_id, page_id, round(score, 6) AS score FROM o",
    "lexical_search": f"WITH {_ROUTED}, {_PAGES_BM25}, r AS ({_ranked('', K, 'g')}) SELECT item_id, doc_id AS page_id, rank, round(score, 6) AS score FROM r WHERE round(score, 6) > 0",
    "routed_fusion": f"""WITH {_ROUTED}, {_PAGES_BM25}, l AS (SELECT * FROM ({_ranked('', 20, 'g')}) WHERE round(score, 6) > 0), u AS ({_UNIT}),
c AS (SELECT a.vec_id AS item_id, b.vec_id AS doc_id, list_dot_product(a.v, b.v) / (a.n * b.n) AS score FROM u a JOIN benchmark ON item_id = a.vec_id CROSS JOIN u b WHERE b.vec_id IN (SELECT page_id FROM pages)
  AND (a.vec_id NOT IN (SELECT item_id FROM o) OR (a.vec_id, b.vec_id) IN (SELECT (item_id, page_id) FROM o))), d AS ({_ranked('', 20, 'c')}),
y AS (SELECT item_id, doc_id, d.rank AS dense_rank, round(d.score, 6) AS dense_score, l.rank AS lexical_rank, round(l.score, 6) AS lexical_score, coalesce(0.4::DOUBLE / (60 + d.rank), 0) + coalesce(0.6::DOUBLE / (60 + l.rank), 0) AS score FROM d FULL JOIN l USING (item_id, doc_id))
SELECT item_id, doc_id AS page_id, dense_rank, dense_score, lexical_rank, lexical_score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank, round(score, 6) AS score, item_id IN (SELECT item_id FROM o) AS metadata_routed FROM y QUALIFY rank <= 4""",
    "dense_topk": f"WITH {_NEAR} SELECT query_id, vec_id, rank, round(cosine, 6) AS cosine FROM r WHERE rank <= 5",
    "dense_threshold": f"WITH {_NEAR} SELECT query_id, vec_id, round(cosine, 6) AS cosine FROM r WHERE rank <= 8 AND round(cosine, 6) >= 0.35",
    "dense_label_recall": f"WITH {_NEAR}, m AS (SELECT query_id, gold, min(CASE WHEN label = gold THEN rank END) AS first FROM r WHERE rank <= 5 GROUP BY ALL) SELECT gold, count(*) AS cases, round(avg((first IS NOT NULL)::INT), 6) AS recall, round(avg(coalesce(1.0::DOUBLE / first, 0)), 6) AS mrr FROM m GROUP BY gold",
    "rrf_equal": _rrf_sql(1, 1, K),
    "rrf_weighted": _rrf_sql(0.4, 0.6, 4),
    "alpha_fusion": _top_sql(f"{_bm25_sql(False, words=False)}, {_ITEM}, l AS ({_ranked('', 20)}), f AS ({_fused('0.7::DOUBLE')})", name="f"),
    "experiment_summary": f"WITH {_bm25_sql(True)}, {_ITEM}, l AS ({_ranked('', 20)}), g AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id), "
    + ", ".join(f"f{k} AS (SELECT {a}::DOUBLE AS alpha, item_id, doc_id, score FROM ({_fused(f'{a}::DOUBLE')}) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) <= {K})" for k, a in enumerate((0.3, 0.5, 0.7, 1.0)))
    + " SELECT alpha, count(*) AS hits, count(quality) AS judged, round(avg(quality), 6) AS good_share, round(avg(round(score, 6)), 5) AS mean_score FROM (" + " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(4)) + ") LEFT JOIN g USING (doc_id) GROUP BY alpha",
    "evidence_recall": f"""WITH {_bm25_sql(True)}, r AS ({_ranked('', K)}), gd AS (SELECT item_id, source AS gold FROM benchmark JOIN documents ON doc_id = item_id),
h AS (SELECT r.item_id, r.doc_id, r.rank FROM r JOIN documents USING (doc_id) JOIN gd ON gd.item_id = r.item_id AND gd.gold = source),
have AS (SELECT item_id, count(DISTINCT term) AS have FROM h JOIN p USING (doc_id) JOIN q USING (item_id, term) GROUP BY item_id),
c AS (SELECT gd.item_id, min(rank) AS first, (SELECT count(*) FROM q WHERE q.item_id = gd.item_id) AS need, coalesce(any_value(have), 0) AS have FROM gd LEFT JOIN h USING (item_id) LEFT JOIN have USING (item_id) GROUP BY gd.item_id)
SELECT count(*) AS cases, round(avg((first IS NOT NULL)::INT), 6) AS source_recall, round(avg((first IS NOT NULL AND have = need)::INT), 6) AS evidence_recall, round(avg(coalesce(1.0::DOUBLE / first, 0)), 6) AS mrr FROM c""",
    "eval_term_hit": f"WITH {_bm25_sql(True)}, r AS ({_ranked('', 4)}), h AS (SELECT item_id, doc_id, count(*) AS have FROM r JOIN p USING (doc_id) JOIN q USING (item_id, term) GROUP BY ALL), b AS (SELECT item_id, max(have) AS best FROM h GROUP BY item_id) SELECT q.item_id, coalesce(any_value(best) = count(*), false) AS hit FROM q LEFT JOIN b USING (item_id) GROUP BY q.item_id",
}

"""Queries on documents, pages and vectors: tokens, windows, versions, audits, reading, chunks, snapshots, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import blank_tokens, bounded_lines, clean, folded, headings, lexical_tokens, line_windows, lines, normal_markdown, normalized_dates, sentences, short_hash, truncated, word_count, word_tokens
from quarrylight.operators import captions, chunking, corpus, embedding, evidence, layout, ordered, reading, semantic, web


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _counted(docs: DataFrame, tokens) -> DataFrame:
    return docs.select("doc_id", tokens.alias("t")).select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_distinct"))


def tokens_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words and pairs of ideographs: number and distinct number in every document."""
    return _counted(_t(spark, sf, "documents"), word_tokens(F.col("text")))


def tokens_blank(spark: SparkSession, sf: str) -> DataFrame:
    """The same for tokens between blanks."""
    return _counted(_t(spark, sf, "documents"), blank_tokens(F.col("text")))


def tokens_lexical(spark: SparkSession, sf: str) -> DataFrame:
    """The same for folded words with inner joiners and pairs and triples of ideographs."""
    docs = _t(spark, sf, "documents").select("doc_id", folded(F.col("text")).alias("folded"))
    return _counted(docs, lexical_tokens(F.col("folded")))


def windows(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping windows of bounded lines of every document."""
    docs = _t(spark, sf, "documents").select("doc_id", F.explode(line_windows(bounded_lines(F.col("text")))).alias("w"))
    text = F.array_join("w.lines", "\n")
    return docs.select("doc_id", F.col("w.start_line").cast("long").alias("start_line"), F.size("w.lines").cast("long").alias("n_lines"), F.sha2(text, 256).alias("sha"))


def scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Scalar functions on every document."""
    text = F.col("text")
    return _t(spark, sf, "documents").select(
        "doc_id",
        word_count(text).cast("long").alias("words"),
        F.size(sentences(text)).cast("long").alias("sentences"),
        F.size(lines(text)).cast("long").alias("lines"),
        F.sha2(clean(text), 256).alias("clean_sha"),
        truncated(clean(text), 80).alias("head"),
        F.sha2(normal_markdown(text), 256).alias("markdown_sha"),
        F.size(headings(text)).cast("long").alias("headings"),
        F.array_join(normalized_dates(text), ",").alias("dates"),
        short_hash(text, 24).alias("chunk_key"),
    )


def doc_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of origins and versions of contents."""
    docs = _t(spark, sf, "documents")
    return corpus.versions(docs, F.concat_ws(":", "source", F.col("doc_id").cast("string")), F.col("text")).select("doc_id", "key", "version")


def _older(docs: DataFrame) -> DataFrame:
    """Texts as they were: every fifth one shorter by its last character."""
    return docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")))


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """An older state of the corpus, before every third document came."""
    return _older(_t(spark, sf, "documents").where("doc_id % 3 <> 0"))


def upsert_changed(spark: SparkSession, sf: str) -> DataFrame:
    """All documents arriving at an older state of the corpus: what is new or changed, and what is refused as blank."""
    keyed = lambda d: corpus.versions(d, F.col("doc_id").cast("string"), F.col("text")).select("key", "version", "doc_id", "text")
    _, report = corpus.upsert(keyed(_stored(spark, sf)), keyed(_t(spark, sf, "documents")))
    return report


def index_sync(spark: SparkSession, sf: str) -> DataFrame:
    """What an index of the labelled documents must add and delete to hold all documents."""
    return corpus.index_changes(_t(spark, sf, "labels").select("doc_id"), _t(spark, sf, "documents").select("doc_id"), "doc_id")


def corpus_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Files, bytes, characters and distinct contents of each language."""
    return corpus.audit(_t(spark, sf, "documents"), "lang")


def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Contents that several documents have."""
    return corpus.copies(_t(spark, sf, "documents"))


def chunk_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Number and sizes of the windows of each source."""
    docs = _t(spark, sf, "documents").select("source", F.explode(line_windows(bounded_lines(F.col("text")))).alias("w"))
    return corpus.chunk_statistics(docs.select("source", F.array_join("w.lines", "\n").alias("text")), "source")


def read_window(spark: SparkSession, sf: str) -> DataFrame:
    """The first 100 bounded lines of every document within the budget."""
    return reading.read_lines(_t(spark, sf, "documents")).withColumn("text", F.sha2("text", 256))


def section_window(spark: SparkSession, sf: str) -> DataFrame:
    """The section around the third bounded line of every document."""
    return reading.sections(_t(spark, sf, "documents"), 3)


def recursive_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the plain recursive splitter, each chunk led by the end of the one before."""
    return chunking.chunk(_t(spark, sf, "documents"), "recursive", 512, 64)


def merged_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the merging splitter, with the place of each chunk."""
    return chunking.chunk(_t(spark, sf, "documents"), "merging", 872, 160)


def page_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Title, headings, links, words and slug of every page."""
    return web.snapshot(_t(spark, sf, "pages"))


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct links of every page, inside or outside of its host."""
    return web.links(_t(spark, sf, "pages"))


def canonical_urls(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical form of every address."""
    return _t(spark, sf, "pages").select("page_id", web.canonical(F.col("url")).alias("canonical"))


def semantic_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of a label in id order as the sentences of a text: segments between breaks of similarity."""
    return ordered.segments(_t(spark, sf, "embeddings"), "label", "vec_id").withColumn("sim", F.round("sim", 6))


def semantic_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cut where neighbouring sentences share least; vectors of sentences are hashed counts of their tokens."""
    cut = semantic.chunks(_t(spark, sf, "documents").select("doc_id", "text"), embedding.hashing())
    return cut.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.col("n_sentences").cast("long").alias("n_sentences"), F.sha2("text", 256).alias("sha"))


def section_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of documents as layout elements (first line of each 5: a heading; pages of 8 lines): title as of each line."""
    rows = _t(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(lines(F.col("text"))).alias("index", "content"))
    elements = rows.withColumn("page", F.floor(F.col("index") / 8).cast("int")).withColumn("type", F.when(F.col("index") % 5 == 2, "heading").otherwise("text"))
    return layout.section_titles(elements).select(F.col("doc").alias("doc_id"), F.col("index").cast("long").alias("index"), F.sha2("section_title", 256).alias("title_sha"))


def _versions(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", short_hash(F.col("text"), 20).alias("version"), "text")


def evidence_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence read from every document as it was, held against those of today; the scope is one language."""
    docs = _t(spark, sf, "documents")
    return evidence.validated(_versions(_older(docs)), _versions(docs), docs.where("lang = 'en'")).select("doc_id", "valid")


def note_states(spark: SparkSession, sf: str) -> DataFrame:
    """Notes that name up to ten documents each, as they were: whether those are current. A corpus without its German documents lacks some."""
    docs = _t(spark, sf, "documents")
    noted = _versions(_older(docs)).select(F.floor(F.col("doc_id") / 10).alias("note_id"), "doc_id", "version")
    return evidence.note_states(noted, _versions(docs.where("NOT lang <=> 'de'")))


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of documents as layout elements: pages of 8 lines; of 7 lines one is an image's caption and one a heading."""
    rows = _t(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(lines(F.col("text"))).alias("index", "content"))
    kind = F.when(F.col("index") % 7 == 3, "image").when(F.col("index") % 7 == 5, "heading").otherwise("text")
    return rows.select("doc", "index", F.floor(F.col("index") / 8).cast("int").alias("page"), kind.alias("type"), clean(F.col("content")).alias("content"), F.when(kind == "image", F.concat(F.lit("img-"), F.col("index"), F.lit(".png"))).alias("source"))


def caption_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Every image's chunk of its own: its section, its caption and the text around it."""
    elements = layout.section_titles(captions.with_context(_elements(spark, sf)))
    images = elements.where("type = 'image'").select("doc", "index", "page", F.concat(F.lit("imgcap-"), F.col("index")).alias("image_id"), F.col("source").alias("path"), F.col("content").alias("caption"), "section_title", "context_before", "context_after")
    return images.select(F.col("doc").alias("doc_id"), F.col("index").cast("long").alias("index"), F.sha2(captions.separate_content(), 256).alias("chunk_sha"), F.sha2(captions.inline_marker(), 256).alias("marker_sha"))


def inline_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with captions in the place of their images."""
    elements = layout.section_titles(_elements(spark, sf))
    known = elements.where("type = 'image'").select("doc", "index", "page", F.concat(F.lit("imgcap-"), F.col("index")).alias("image_id"), F.col("source").alias("path"), F.col("content").alias("caption"), "section_title")
    return captions.page_documents(captions.reading_units(elements, known)).select(F.col("doc").alias("doc_id"), "page", F.sha2("text", 256).alias("text_sha"))


def paged_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the splitter for pages."""
    return chunking.chunk(_t(spark, sf, "documents"), "paged", 700, 120)


QUERIES = {f.__name__: f for f in (tokens_words, tokens_blank, tokens_lexical, windows, scalars, doc_versions, upsert_changed, index_sync, corpus_audit, exact_duplicates, chunk_statistics, read_window, section_window, recursive_chunks, merged_chunks, page_snapshot, page_links, canonical_urls, semantic_segments, semantic_chunks, section_titles, evidence_validation, note_states, caption_chunks, inline_pages, paged_chunks)}

_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_L = rf"(SELECT *, CASE WHEN text = '' THEN [] WHEN l[-1] = '' THEN l[:-2] ELSE l END AS ls FROM (SELECT *, string_split_regex(text, '{_BREAK}') AS l FROM documents))"
_B = f"(SELECT *, flatten(list_transform(ls, lambda s: list_transform(range(0, greatest(len(s), 1), 300), lambda k: substr(s, k + 1, 300)))) AS bl FROM {_L})"
_WIN = f"(SELECT doc_id, source, st + 1 AS start_line, list_slice(bl, st + 1, st + 24) AS wl FROM (SELECT *, unnest(range(0, len(bl), 16)) AS st FROM {_B}))"
_COUNTED = "SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct FROM (SELECT doc_id, {} AS t FROM documents)"
_OLDER = "(SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN left(text, length(text) - 1) ELSE text END AS text FROM documents)"
_STORED = f"(SELECT * FROM {_OLDER} WHERE doc_id % 3 <> 0)"
_CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"

ORACLES = {
    "evidence_validation": rf"SELECT o.doc_id, coalesce(d.lang = 'en', false) AND d.text = o.text AND regexp_matches(o.text, '\S') AS valid FROM {_OLDER} o JOIN documents d USING (doc_id)",
    "note_states": f"SELECT o.doc_id // 10 AS note_id, CASE WHEN count(*) FILTER (d.lang = 'de') > 0 THEN 'missing' WHEN count(*) FILTER (d.text <> o.text) > 0 THEN 'stale' ELSE 'current' END AS state FROM {_OLDER} o JOIN documents d USING (doc_id) GROUP BY 1",
    "tokens_words": _COUNTED.format(r"regexp_extract_all(lower(text), '[a-z0-9_]+|[\x{4e00}-\x{9fff}]+')"),
    "tokens_blank": _COUNTED.format(r"list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')"),
    "tokens_lexical": _COUNTED.format(r"regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+(?:[._+#/-][a-z0-9]+)*|[\x{3400}-\x{9fff}]+')"),
    "windows": f"SELECT doc_id, start_line, len(wl) AS n_lines, sha256(array_to_string(wl, chr(10))) AS sha FROM {_WIN}",
    "scalars": rf"""SELECT doc_id, len(regexp_extract_all(text, '[\x{{4e00}}-\x{{9fff}}]|[\p{{L}}\p{{N}}_]+')) AS words,
len(list_filter(list_transform(regexp_extract_all(text, '[^。！？.!?\n]*[。！？.!?\n]|[^。！？.!?\n]+$'), lambda x: trim(x, E' \t\n\r\x0b\x0c')), lambda x: x <> '')) AS sentences,
len(ls) AS lines, sha256({_CLEAN}) AS clean_sha,
CASE WHEN length({_CLEAN}) <= 80 THEN {_CLEAN} ELSE rtrim(substr({_CLEAN}, 1, 79)) || '...' END AS head,
sha256(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g') || chr(10)) AS markdown_sha,
len(list_distinct(regexp_extract_all(text, '(?m)^#{{1,3}}\s+(.+)$', 1))) AS headings,
array_to_string(list_transform(list_sort(list_distinct(regexp_extract_all(text, '\d{{4}}-\d{{1,2}}-\d{{1,2}}'))), lambda d: d), ',') AS dates,
substr(sha256(text), 1, 24) AS chunk_key FROM {_L}""",
    "doc_versions": "SELECT doc_id, substr(sha256(source || ':' || doc_id), 1, 20) AS key, substr(sha256(text), 1, 20) AS version FROM documents",
    "upsert_changed": rf"SELECT substr(sha256(d.doc_id::VARCHAR), 1, 20) AS key, substr(sha256(d.text), 1, 20) AS version, (o.text IS DISTINCT FROM d.text) AND NOT regexp_full_match(d.text, '\s*') AS changed, regexp_full_match(d.text, '\s*') AS refused FROM documents d LEFT JOIN {_STORED} o USING (doc_id)",
    "index_sync": "SELECT DISTINCT doc_id, 'add' AS action FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'delete' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)",
    "corpus_audit": "SELECT lang, count(*) AS files, sum(strlen(text))::BIGINT AS bytes, sum(length(text))::BIGINT AS chars, bool_and(length(text) > 0) AS all_filled, count(DISTINCT sha256(text)) AS contents FROM documents GROUP BY lang",
    "exact_duplicates": "SELECT sha256(text) AS sha, count(*) AS copies, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "chunk_statistics": f"SELECT source, count(*) AS chunks, min(length(x)) AS shortest, max(length(x)) AS longest, round(avg(length(x)), 2) AS mean_chars FROM (SELECT source, array_to_string(wl, chr(10)) AS x FROM {_WIN}) GROUP BY source",
    "read_window": f"""WITH x AS (SELECT doc_id, len(bl) AS n, list_slice(bl, 1, 100) AS c FROM {_B} WHERE len(bl) > 0),
u AS (SELECT doc_id, n, c, len(list_filter(range(1, len(c) + 1), lambda k: list_sum(list_transform(list_slice(c, 1, k), lambda s: len(s) + 1)) <= 10000)) AS m FROM x)
SELECT doc_id, 1::BIGINT AS start_line, m AS lines_read, coalesce(list_sum(list_transform(list_slice(c, 1, m), lambda s: len(s))), 0)::BIGINT AS chars_read, CASE WHEN 1 + m <= n THEN 1 + m END AS next_start_line, sha256(array_to_string(list_slice(c, 1, m), chr(10))) AS text FROM u""",
    "page_snapshot": r"""WITH s AS (SELECT page_id, url, html, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title,
regexp_extract_all(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1) AS heads, list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"#]*)', 1)) AS links,
trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM pages)
SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, CASE WHEN title <> '' THEN title ELSE coalesce(trim(regexp_replace(regexp_replace(heads[1], '<[^>]*>', '', 'g'), '\s+', ' ', 'g')), '') END AS title,
len(heads) AS n_headings, len(links) AS n_links, len(regexp_extract_all(body, '[\x{4e00}-\x{9fff}]|[\p{L}\p{N}_]+')) AS n_words,
substr(coalesce(nullif(regexp_replace(regexp_replace(rtrim(regexp_extract(url, '^https?://([^?#]*)', 1), '/') || CASE WHEN regexp_extract(url, '\?([^#]+)', 1) <> '' THEN '_' || regexp_extract(url, '\?([^#]+)', 1) ELSE '' END, '[^\p{L}\p{N}._-]', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'page'), 1, 100) AS slug FROM s""",
    "page_links": r"""WITH r AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base, unnest(list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1))) AS href FROM pages),
h AS (SELECT page_id, base, regexp_replace(href, '#.*$', '') AS href FROM r), t AS (SELECT page_id, base, CASE WHEN href LIKE '/%' AND href NOT LIKE '//%' THEN base || href ELSE href END AS target FROM h)
SELECT DISTINCT page_id, target, regexp_extract(target, '^https?://([^/?#]+)', 1) = regexp_extract(base, '^https?://([^/?#]+)', 1) AS internal FROM t WHERE regexp_matches(target, '^https?://')""",
    "canonical_urls": r"SELECT page_id, CASE WHEN regexp_matches(url, '^https://[^/@\s]+') THEN regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '\.md$', '') END AS canonical FROM pages",
    "semantic_segments": """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS w FROM embeddings),
s AS (SELECT vec_id, label, list_dot_product(v, w) / sqrt(list_dot_product(v, v) * list_dot_product(w, w)) AS sim FROM e), c AS (SELECT label, quantile_cont(sim, 0.3::DOUBLE) AS cut FROM s GROUP BY label),
p AS (SELECT vec_id, s.label, sim, sum(coalesce(round(sim, 9) < round(cut, 9), false)::INT) OVER (PARTITION BY s.label ORDER BY vec_id) AS part FROM s JOIN c ON s.label IS NOT DISTINCT FROM c.label)
SELECT vec_id, label, round(sim, 6) AS sim, part::BIGINT AS part, (row_number() OVER (PARTITION BY label, part ORDER BY vec_id) - 1) // 10 AS sub FROM p""",
    "semantic_chunks": r"""WITH d AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^。！？.!?\n]*[。！？.!?\n]|[^。！？.!?\n]+$'), lambda x: trim(x, E' \t\n\r\x0b\x0c')), lambda x: x <> '') AS ss FROM documents),
x AS (SELECT doc_id, generate_subscripts(ss, 1) AS i, unnest(ss) AS s, len(ss) AS n FROM d),
b AS MATERIALIZED (SELECT doc_id, i, ('0x' || substr(md5(t), 1, 8))::BIGINT % 256 AS place, count(*) AS c FROM (SELECT doc_id, i, unnest(regexp_extract_all(lower(s), '[a-z0-9_]+|[\x{4e00}-\x{9fff}]+')) AS t FROM x) GROUP BY ALL),
m AS (SELECT doc_id, i, sum(c * c)::DOUBLE AS q FROM b GROUP BY ALL),
p AS (SELECT a.doc_id, a.i, sum(a.c * z.c)::DOUBLE AS dot FROM b a JOIN b z ON z.doc_id = a.doc_id AND z.i = a.i + 1 AND z.place = a.place GROUP BY ALL),
v AS (SELECT x.doc_id, x.i, x.s, x.n, CASE WHEN x.i < x.n THEN coalesce(p.dot / sqrt(m.q * w.q), 0) END AS sim FROM x LEFT JOIN p USING (doc_id, i) LEFT JOIN m USING (doc_id, i) LEFT JOIN m w ON w.doc_id = x.doc_id AND w.i = x.i + 1),
c AS (SELECT doc_id, quantile_cont(sim, 0.3::DOUBLE) AS cut FROM v GROUP BY doc_id),
k AS (SELECT v.*, coalesce(sum(coalesce(round(sim, 9) < round(cut, 9), false)::INT) OVER (PARTITION BY v.doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM v JOIN c USING (doc_id)),
y AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, run ORDER BY i) - 1) // 10 AS piece FROM k)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY run, piece) - 1 AS chunk, count(*) AS n_sentences, sha256(string_agg(s, '' ORDER BY i)) AS sha FROM y GROUP BY doc_id, run, piece""",
    "section_titles": f"""WITH x AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS index, unnest(ls) AS content FROM {_L}), h AS (SELECT *, index // 8 AS page, CASE WHEN index % 5 = 2 THEN content END AS head FROM x)
SELECT doc_id, index, sha256(coalesce(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS title_sha FROM h""",
}

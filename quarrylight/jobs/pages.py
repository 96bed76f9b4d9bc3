"""Queries that make Markdown and snapshots of pages, from their html and from what crawling services return for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import clean
from quarrylight.operators import snapshots, web


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def page_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a snapshot of its html: Markdown with absolute addresses, links inside and outside of its host."""
    made = snapshots.of_html(_t(spark, sf, "pages"))
    return made.select("page_id", "url", "title", F.sha2("markdown", 256).alias("markdown_sha"), F.col("words"), F.size("headings").cast("long").alias("n_headings"), "links_internal", "links_external")


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as services return them, by the last digit of the id: 0 is cut short, 1 is of an unknown service, 2 failed, 3 is empty; the
    others alternate between two services."""
    html, digit = F.col("html"), F.col("page_id") % 10
    title = clean(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    text = F.when(digit == 3, " ").otherwise(F.concat(F.lit("# "), title, F.lit("\n\n"), web.plain(html)))
    hrefs = F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=\"([^\"]*)\""), F.lit(1))
    image = F.concat(F.lit("/i/"), F.col("page_id").cast("string"), F.lit(".png"))
    status = F.when(digit == 2, 503).otherwise(200).alias("status_code")
    flat = F.struct(text.alias("markdown"), hrefs.alias("links"), F.array(image, image).alias("images"), F.struct(F.col("url"), status, F.lit("about it").alias("og_description")).alias("metadata"))
    links = F.struct(F.transform(hrefs, lambda h: F.struct(h.alias("href"))).alias("internal"), F.array(F.struct(F.lit("https://other.example/x").alias("href"))).alias("external"))
    deep = F.struct(F.struct(text.alias("raw_markdown"), F.lit("").alias("fit_markdown")).alias("markdown"), links.alias("links"), F.struct(F.array(F.struct(image.alias("src"))).alias("images")).alias("media"), F.col("url"), status, F.struct(title.alias("title")).alias("metadata"))
    is_flat = F.col("page_id") % 2 == 0
    payload: Column = F.when(is_flat, F.to_json(flat)).otherwise(F.to_json(deep))
    provider = F.when(digit == 1, "unheard").when(is_flat, "firecrawl").otherwise("crawl4ai")
    return _t(spark, sf, "pages").select("page_id", provider.alias("provider"), F.col("url").alias("source_url"), F.when(digit == 0, F.left(payload, F.lit(40))).otherwise(payload).alias("payload"))


def page_records(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of two services as one schema, and those set apart with the reason; a row for every page."""
    good, apart = snapshots.of_payloads(_payloads(spark, sf))
    n = lambda c: F.size(c).cast("long")
    told = good.select("page_id", "provider", "url", "title", "description", "words", n("links_internal").alias("n_internal"), n("links_external").alias("n_external"), n("images").alias("n_images"), F.lit(None).cast("string").alias("reason"))
    none = {c: F.lit(None).cast(told.schema[c].dataType) for c in told.columns}
    return told.unionByName(apart.select(*(F.col(c) if c in apart.columns else none[c].alias(c) for c in told.columns)))


QUERIES = {f.__name__: f for f in (page_markdown, page_records)}

_PLAIN = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
ORACLES = {
    "page_records": rf"""WITH s AS (SELECT page_id, url, page_id % 10 AS digit, page_id % 2 = 0 AS flat, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title, {_PLAIN} AS body,
  list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1)) AS hrefs, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base FROM pages),
k AS (SELECT *, list_distinct(list_transform(hrefs, lambda h: CASE WHEN h LIKE '/%' THEN base || h ELSE h END)) AS whole FROM s)
SELECT page_id, CASE WHEN digit = 1 THEN 'unheard' WHEN flat THEN 'firecrawl' ELSE 'crawl4ai' END AS provider, CASE WHEN digit > 3 THEN url END AS url, CASE WHEN digit > 3 THEN title END AS title,
CASE WHEN digit > 3 AND flat THEN 'about it' END AS description, CASE WHEN digit > 3 THEN len(regexp_extract_all('# ' || title || chr(10) || chr(10) || body, '[\x{{4e00}}-\x{{9fff}}]|[\p{{L}}\p{{N}}_]+')) END AS words,
CASE WHEN digit > 3 AND flat THEN len(list_filter(whole, lambda h: starts_with(h, base || '/'))) WHEN digit > 3 THEN len(hrefs) END AS n_internal,
CASE WHEN digit > 3 AND flat THEN len(list_filter(whole, lambda h: starts_with(h, 'http') AND NOT starts_with(h, base || '/'))) WHEN digit > 3 THEN 1 END AS n_external, CASE WHEN digit > 3 THEN 1 END AS n_images,
CASE digit WHEN 0 THEN 'unreadable' WHEN 1 THEN 'unknown provider' WHEN 2 THEN 'status 503' WHEN 3 THEN 'no markdown' END AS reason FROM k""",
}

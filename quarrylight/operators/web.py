"""Web pages: snapshots, links and addresses, with built-ins on the raw html."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.text import clean, url_slug, word_count

URL = r"https?://[^\s<>\"')\]]+"


def plain(html: Column) -> Column:
    """Text of the body without scripts, styles and tags."""
    body = F.regexp_replace(html, r"(?is)<(script|style|title)[^>]*>.*?</\1>", " ")
    return clean(F.regexp_replace(F.regexp_replace(body, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " "))


def snapshot(pages: DataFrame) -> DataFrame:
    """(page_id, host, title, headings, links, words, slug); the first heading stands in for a missing title."""
    html = F.col("html")
    title = clean(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    heads = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1)), lambda h: clean(F.regexp_replace(h, r"<[^>]*>", "")))
    links = F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=\"([^\"#]*)"), F.lit(1)))
    return pages.select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"),
        F.when(title != "", title).otherwise(F.coalesce(F.get(heads, 0), F.lit(""))).alias("title"),
        F.size(heads).cast("long").alias("n_headings"),
        F.size(links).cast("long").alias("n_links"),
        word_count(plain(html)).cast("long").alias("n_words"),
        url_slug(F.col("url")).alias("slug"),
    )


def links(pages: DataFrame) -> DataFrame:
    """(page_id, target, internal): distinct http links; rooted ones are completed, fragments dropped."""
    base = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    raw = pages.select("page_id", base.alias("base"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*href=\"([^\"]*)\""), F.lit(1)))).alias("href"))
    href = F.regexp_replace("href", "#.*$", "")
    target = F.when(href.startswith("/") & ~href.startswith("//"), F.concat("base", href)).otherwise(href)
    found = raw.select("page_id", "base", target.alias("target")).where(F.col("target").rlike("^https?://"))
    host = lambda c: F.regexp_extract(c, r"^https?://([^/?#]+)", 1)
    return found.select("page_id", "target", (host("target") == host("base")).alias("internal")).distinct()


def canonical(url: Column) -> Column:
    """Secure addresses without query, fragment, trailing slash and markdown suffix; null for others."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.when(url.rlike(r"^https://[^/@\s]+"), F.regexp_replace(F.regexp_replace(bare, r"/+$", ""), r"\.md$", ""))


#: Most characters of a page that is taken in.
PAGE_CHARS = 1_000_000


def taken_in(pages: DataFrame, url_col: str = "url", text_col: str = "text", longest: int = PAGE_CHARS) -> tuple[DataFrame, DataFrame]:
    """(pages to take in, pages refused with a reason): addresses must be http ones without a user, texts neither blank nor too long."""
    url, text = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    reason = (
        F.when(~url.rlike(r"(?i)^https?://(?:[^/?#@]*@)?[^/?#@:]"), "no http address")
        .when(url.rlike(r"^[^/]*//[^/?#]*@"), "address with a user")
        .when(~text.rlike(r"\S"), "empty")
        .when(F.length(text) > longest, "too long")
    )
    marked = pages.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def catalogue(indexes: DataFrame, host: str, prefix: str, text_col: str = "text") -> DataFrame:
    """(columns of indexes but the text, place, title, url): Markdown pages that an index links to on a host below a path, each once at its
    first place with its last title."""
    found = F.regexp_extract_all(text_col, F.lit(r"\[[^\]]+\]\(https://[^\s)]+\)"), F.lit(0))
    others = [c for c in indexes.columns if c != text_col]
    each = indexes.select(*others, F.posexplode(found).alias("place", "__l"))
    linked = each.select(*others, "place", F.regexp_extract("__l", r"^\[([^\]]+)\]", 1).alias("title"), F.regexp_extract("__l", r"\((https://[^\s)]+)\)$", 1).alias("url"))
    path = F.regexp_extract("url", r"^https://[^/?#]*([^?#]*)", 1)
    on = (F.regexp_extract("url", r"^https://([^/?#]*)", 1) == host) & path.startswith(prefix) & path.endswith(".md") & ~F.contains("url", F.lit("?"))
    return linked.where(on).groupBy(*others, "url").agg(F.min("place").alias("place"), F.max_by("title", "place").alias("title")).select(*others, "place", "title", "url")

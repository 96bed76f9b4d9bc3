"""Page snapshots of one schema: from raw html, and from what crawling services return, whatever their shape.

A payload is read once as a variant; each field is the first of its paths that holds something. Payloads that can't be
read, that no known shape fits or that report an error go apart, with the reason, and are never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.markdown import markdown
from quarrylight.functions.text import clean, headings, normal_markdown, url_slug, word_count
from quarrylight.functions.urls import resolved
from quarrylight.jobs.shared import written

#: For each provider the paths of its fields, first ones first. Links are references, or objects with an address in them.
PATHS = {
    "firecrawl": {
        "url": ("$.metadata.url", "$.metadata.source_url"),
        "markdown": ("$.markdown",),
        "title": ("$.metadata.title",),
        "description": ("$.metadata.description", "$.metadata.og_description"),
        "status": ("$.metadata.status_code",),
        "links": ("$.links",),
        "images": ("$.images",),
    },
    "crawl4ai": {
        "url": ("$.redirected_url", "$.url"),
        "markdown": ("$.markdown.fit_markdown", "$.markdown.raw_markdown", "$.markdown"),
        "title": ("$.metadata.title",),
        "description": ("$.metadata.description",),
        "status": ("$.status_code",),
        "internal": ("$.links.internal",),
        "external": ("$.links.external",),
        "images": ("$.media.images",),
    },
}
FIELDS = ("url", "markdown", "title", "description", "status", "links", "internal", "external", "images")


def _text(told: Column, path: str, kind: str = "string") -> Column:
    """The text at a path; null if it isn't a text or number, or is empty."""
    v = F.try_variant_get(told, path, "variant")
    plain = F.schema_of_variant(v).rlike("^(STRING|BIGINT|INT|DECIMAL|DOUBLE)")
    return F.nullif(F.when(plain, F.try_variant_get(told, path, "string")), F.lit("")).cast(kind) if kind == "string" else F.when(plain, F.try_variant_get(told, path, kind))


def _references(told: Column, path: str) -> Column:
    """The references at a path: of texts themselves, of objects their href or src."""
    each = F.try_variant_get(told, path, "array<variant>")
    of = lambda v: F.coalesce(F.try_variant_get(v, "$.href", "string"), F.try_variant_get(v, "$.src", "string"), F.try_variant_get(v, "$.url", "string"), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.filter(F.transform(each, of), lambda x: x.isNotNull())


def _of_provider(told: Column, name: str) -> Column:
    paths = PATHS[name]
    first = lambda field, make: F.coalesce(*(make(told, p) for p in paths.get(field, ())), F.lit(None))
    out = {f: first(f, _text) for f in ("url", "markdown", "title", "description")}
    out["status"] = first("status", lambda t, p: _text(t, p, "int"))
    out |= {f: first(f, _references) for f in ("links", "internal", "external", "images")}
    return F.struct(*((out[f].cast("array<string>") if f in ("links", "internal", "external", "images") else out[f].cast("int" if f == "status" else "string")).alias(f) for f in FIELDS))


def of_payloads(payloads: DataFrame, id_col: str = "page_id") -> tuple[DataFrame, DataFrame]:
    """(snapshots, set apart) of payloads (id, provider, source_url, payload: JSON text).

    Snapshots are those of finished(); what is set apart keeps its columns and gets a reason: unreadable, unknown
    provider, no markdown, or a status of 400 and more.
    """
    told = payloads.select(F.col(id_col).alias("__id"), "provider", "source_url", "payload", F.try_parse_json("payload").alias("__v"))
    fields = None
    for name in PATHS:
        mine = F.when(F.col("provider") == name, _of_provider(F.col("__v"), name))
        fields = mine if fields is None else F.coalesce(fields, mine)
    read = told.select("__id", "provider", "source_url", "payload", F.col("__v").isNull().alias("__bad"), fields.alias("__f"))
    reason = (
        F.when(F.coalesce(~F.col("provider").isin(*PATHS), F.lit(True)), "unknown provider")
        .when(F.col("__bad"), "unreadable")
        .when(F.col("__f.status") >= 400, F.concat(F.lit("status "), F.col("__f.status").cast("string")))
        .when(F.coalesce(F.length(F.trim("__f.markdown")) == 0, F.lit(True)), "no markdown")
    )
    kept = F.when(F.col("reason").isNotNull(), F.col("payload")).alias("payload")
    # written once: both results read it, and a filter on the reason would else read every payload anew for each of its terms
    marked = written(read.withColumn("reason", reason).select("__id", "provider", "source_url", kept, "__f", "reason"), "payloads")
    apart = marked.where("reason is not null").select(F.col("__id").alias(id_col), "provider", "source_url", "payload", "reason")
    good = marked.where("reason is null").select(F.col("__id").alias(id_col), "provider", "source_url", "__f.*")
    return finished(good, id_col), apart


def of_html(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Snapshots of raw pages: Markdown, title, description, links and images taken from the html; rows without an address too."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    attribute = lambda tag, name: F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*?\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"), F.lit(0))
    values = lambda found, name: F.transform(found, lambda t: F.regexp_replace(F.regexp_extract(t, rf"(?is)\s{name}\s*=\s*(\"[^\"]*|'[^']*)[\"']$", 1), "^[\"']", ""))
    title = clean(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    described = F.regexp_extract(html, r"(?is)<meta\s[^>]*name\s*=\s*[\"']description[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']", 1)
    none = F.lit(None).cast("array<string>")
    read = pages.select(
        F.col(id_col).alias("__id"),
        F.lit("html").alias("provider"),
        F.col(url_col).alias("source_url"),
        F.lit(None).cast("string").alias("url"),
        markdown(html, F.col(url_col)).alias("markdown"),
        F.nullif(title, F.lit("")).alias("title"),
        F.nullif(described, F.lit("")).alias("description"),
        F.lit(None).cast("int").alias("status"),
        values(attribute("a", "href"), "href").alias("links"),
        none.alias("internal"),
        none.alias("external"),
        values(attribute("img", "src"), "src").alias("images"),
    )
    return finished(read.withColumnRenamed("__id", id_col), id_col)


def _distinct(values: Column) -> Column:
    """Trimmed, without empty ones, each once at its first place."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != ""))


def finished(read: DataFrame, id_col: str) -> DataFrame:
    """(id, provider, url, source_url, slug, title, description, status, words, headings, markdown, links_internal, links_external, images).

    A provider's own split of links is kept as it is; links without one are made absolute and split by host. The first
    heading stands in for a missing title. Fragments are dropped, and what is no http address.
    """
    based = read.withColumn("url", F.coalesce("url", "source_url")).withColumn("markdown", normal_markdown(F.coalesce("markdown", F.lit(""))))
    none = F.array().cast("array<string>")
    found = based.withColumn("__l", resolved(F.coalesce("links", none), F.col("url"))).withColumn("__i", resolved(F.coalesce("images", none), F.col("url"))).withColumn("__h", headings(F.col("markdown")))
    side = lambda inside: F.transform(F.filter("__l", lambda x: x["internal"] == inside), lambda x: x["url"])
    own = F.col("internal").isNotNull() | F.col("external").isNotNull()
    return found.select(
        id_col,
        "provider",
        "url",
        "source_url",
        url_slug(F.col("url")).alias("slug"),
        F.coalesce("title", F.get("__h", F.lit(0))).alias("title"),
        "description",
        "status",
        word_count(F.col("markdown")).cast("long").alias("words"),
        F.col("__h").alias("headings"),
        "markdown",
        F.when(own, _distinct(F.col("internal"))).otherwise(side(True)).alias("links_internal"),
        F.when(own, _distinct(F.col("external"))).otherwise(side(False)).alias("links_external"),
        F.transform("__i", lambda x: x["url"]).alias("images"),
    )

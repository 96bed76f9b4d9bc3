"""Image captions as chunks of their own or in the place of the image, with the text around them.

elements: (doc, page, index, type, content, source); captions: (doc, index, image_id, caption, page, path, section_title).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.operators.decisions import is_placeholder

from quarrylight.functions.text import clean, truncated

#: Types of elements that hold running text, and the forms of caption texts.
TEXT_TYPES = ("paragraph", "heading", "caption", "list item", "text", "text block", "table cell")


def is_text(kind: Column, content: Column) -> Column:
    return (F.coalesce(content, F.lit("")) != "") & (kind.isin(*TEXT_TYPES) | kind.startswith("heading"))


def _enough(parts: Column, chars: int) -> Column:
    """How many of the first parts make, joined by blanks, at least so many characters; all if they don't."""
    begin = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("chars"))
    more = lambda s, p: F.struct((s["n"] + 1).alias("n"), (s["chars"] + F.length(p) + 1).alias("chars"))
    return F.aggregate(parts, begin, lambda s, p: F.when(s["chars"] < chars, more(s, p)).otherwise(s))["n"]


def with_context(elements: DataFrame, before_chars: int = 200, after_chars: int = 200, doc_col: str = "doc") -> DataFrame:
    """Adds context_before and context_after: the text elements nearest on either side, as many as give the characters, cut to them.

    Elements of other pages don't count, unless the element's own page is null. Texts have no blanks beside one another
    (a clean content), so of the texts on a side no more than the characters asked for can matter; windows hold no others.
    """
    told = is_text(F.lower("type"), F.col("content"))
    out = elements
    for name, by in (("p", [doc_col, "page"]), ("d", [doc_col])):
        rows = Window.partitionBy(*by).orderBy("index")
        out = out.withColumn(f"__{name}", F.count_if(told).over(rows.rowsBetween(Window.unboundedPreceding, 0)))
        nth = Window.partitionBy(*by).orderBy(f"__{name}")
        own = F.when(told, F.struct("index", "content"))
        near = lambda a, b, nth=nth, own=own: F.sort_array(F.collect_list(own).over(nth.rangeBetween(a, b)))
        out = out.withColumn(f"__b{name}", near(-before_chars, 0)).withColumn(f"__a{name}", near(0, after_chars))
    pick = lambda side: F.when(F.col("page").isNull(), F.col(f"__{side}d")).otherwise(F.col(f"__{side}p"))
    text = lambda kept: F.transform(kept, lambda x: x["content"])
    out = out.withColumn("__bx", F.reverse(text(F.filter(pick("b"), lambda x: x["index"] < F.col("index"))))).withColumn("__ax", text(F.filter(pick("a"), lambda x: x["index"] > F.col("index"))))
    before = F.array_join(F.reverse(F.slice("__bx", F.lit(1), _enough(F.col("__bx"), before_chars))), " ")
    after = F.array_join(F.slice("__ax", F.lit(1), _enough(F.col("__ax"), after_chars)), " ")
    return out.withColumn("context_before", truncated(clean(before), before_chars)).withColumn("context_after", truncated(clean(after), after_chars)).select(*elements.columns, "context_before", "context_after")


def _or_unknown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("unknown"))


def inline_marker() -> Column:
    """What stands for an image in running text."""
    section = F.when(F.coalesce("section_title", F.lit("")) != "", F.concat(F.lit(' section="'), F.col("section_title"), F.lit('"'))).otherwise("")
    return F.concat(F.lit("[Image id="), F.col("image_id"), F.lit(" page="), _or_unknown("page"), F.lit(" path="), _or_unknown("path"), section, F.lit("] "), F.col("caption"))


def separate_content(context_chars: int = 200) -> Column:
    """A chunk of its own: a header, the caption, and the text around the image."""
    section = F.when(F.coalesce("section_title", F.lit("")) != "", F.concat(F.lit(' | section "'), F.col("section_title"), F.lit('"'))).otherwise("")
    snippet = lambda name: F.when(F.coalesce(f"context_{name}", F.lit("")) != "", F.concat(F.lit(f"{name}: "), truncated(clean(F.col(f"context_{name}")), context_chars)))
    around = F.concat_ws(" | ", snippet("before"), snippet("after"))
    nearby = F.when(around != "", F.concat(F.lit("\nNearby text: "), around)).otherwise("")
    return F.concat(F.lit("[Image caption | page "), _or_unknown("page"), section, F.lit("]\n"), F.col("caption"), nearby)


def reading_units(elements: DataFrame, captions: DataFrame | None = None, doc_col: str = "doc") -> DataFrame:
    """(doc, page, index, text): text elements, and with captions the marker of each captioned image in its place, on its caption's page."""
    units = elements.where(is_text(F.lower("type"), F.col("content"))).select(doc_col, "page", "index", F.col("content").alias("text"))
    if captions is None:
        return units
    images = elements.where((F.lower("type") == "image") & (F.coalesce("source", F.lit("")) != "")).select(doc_col, "index")
    return units.unionByName(images.join(captions, [doc_col, "index"]).select(doc_col, "page", "index", inline_marker().alias("text")))


def page_documents(units: DataFrame, doc_col: str = "doc") -> DataFrame:
    """(doc, page, text): units of a page joined by blank lines, in order; blank ones dropped, units without a page under unknown."""
    filled = units.withColumn("text", clean(F.col("text"))).where("text <> ''").withColumn("page", _or_unknown("page"))
    rows = filled.groupBy(doc_col, "page").agg(F.sort_array(F.collect_list(F.struct("index", "text"))).alias("rows"))  # one page
    return rows.select(doc_col, "page", F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n").alias("text"))


def numbered(chunks: DataFrame, prefix: str, order: list[str], doc_col: str = "doc") -> DataFrame:
    """Adds chunk_id: the prefix and the chunk's number in its document, from 0001."""
    nth = F.row_number().over(Window.partitionBy(doc_col).orderBy(*order))
    return chunks.withColumn("chunk_id", F.concat(F.lit(f"{prefix}-"), F.format_string("%04d", nth)))


def caption_join(images: DataFrame, captions: DataFrame, doc_col: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(images with their captions, images still to be captioned): captions made before are used again by the element's place."""
    known = images.join(captions.select(doc_col, "index", "image_id", "caption"), [doc_col, "index"])
    return known, images.join(captions.select(doc_col, "index"), [doc_col, "index"], "left_anti")


def persisted(made: DataFrame, stored: DataFrame, dry_run: bool, doc_col: str = "doc") -> DataFrame:
    """What to write of captions (doc, index, ...): in a dry run stored ones stay in place of placeholders, so that none is lost."""
    if not dry_run:
        return made
    good = stored.where(~is_placeholder(F.col("caption")))
    lost = made.where(is_placeholder(F.col("caption"))).select(doc_col, "index").join(good, [doc_col, "index"], "left_semi")
    kept = made.join(lost, [doc_col, "index"], "left_anti")
    return kept.unionByName(good.join(lost, [doc_col, "index"], "left_semi").select(*made.columns))

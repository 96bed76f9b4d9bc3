"""Page layout: headings as of an element, captions nearby, reading order, page groups."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def section_titles(elements: DataFrame, doc_col: str = "doc", page_col: str = "page", order_col: str = "index") -> DataFrame:
    """Adds section_title: the nearest heading before on the same page, else the nearest before on any page."""
    head = F.when(F.lower("type").rlike("^(heading|title)"), F.col("content"))
    before = lambda *by: F.last(head, True).over(Window.partitionBy(*by).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1))
    return elements.withColumn("section_title", F.coalesce(before(doc_col, page_col), before(doc_col), F.lit("")))


def nearby_captions(elements: DataFrame, reach: int = 3, doc_col: str = "doc", order_col: str = "index") -> DataFrame:
    """Adds captions: captions within ``reach`` positions on either side."""
    cap = F.when(F.lower("type") == "caption", F.col("content"))
    w = Window.partitionBy(doc_col).orderBy(order_col)
    around = F.concat(F.collect_list(cap).over(w.rowsBetween(-reach, -1)), F.collect_list(cap).over(w.rowsBetween(1, reach)))
    return elements.withColumn("captions", around)


def reading_order(elements: DataFrame) -> DataFrame:
    """Sorted by page, top edge, left edge, index; elements without a box by page, index, 0."""
    boxed = F.size(F.coalesce("bbox", F.array().cast("array<double>"))) == 4
    return elements.orderBy(F.coalesce("page", F.lit(0)), F.when(boxed, F.get("bbox", 1)).otherwise(F.col("index").cast("double")), F.when(boxed, F.get("bbox", 0)).otherwise(F.lit(0.0)), "index")


def page_texts(elements: DataFrame, doc_col: str = "doc") -> DataFrame:
    """(doc, page, text, place): texts of a page joined by blank lines; pages in the order of their numbers as strings."""
    filled = elements.where(F.trim(F.coalesce("content", F.lit(""))) != "")
    rows = filled.groupBy(doc_col, "page").agg(F.sort_array(F.collect_list(F.struct("index", "content"))).alias("rows"))
    place = F.row_number().over(Window.partitionBy(doc_col).orderBy(F.col("page").cast("string")))
    return rows.select(doc_col, "page", F.array_join(F.transform("rows", lambda r: r["content"]), "\n\n").alias("text"), place.alias("place"))


def marked_pages(paragraphs: DataFrame, doc_col: str = "doc", order_col: str = "seq", text_col: str = "paragraph", pattern: str = r"^\s*(?:page|第)\s*(\d+)\s*页?\s*$") -> DataFrame:
    """Adds page: the number of the last page mark at or before a paragraph."""
    number = F.regexp_extract(F.lower(F.col(text_col)), pattern, 1)
    w = Window.partitionBy(doc_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return paragraphs.withColumn("page", F.last(F.when(number != "", number.cast("int")), True).over(w))


def repaired_segments(segments: DataFrame, media_col: str = "media", order_col: str = "pos", least: float = 0.1) -> DataFrame:
    """Ends that don't follow their starts are moved to the next start if that does, else a little after."""
    nxt = F.lead("start").over(Window.partitionBy(media_col).orderBy(order_col))
    end = F.when(F.col("end") > F.col("start"), F.col("end")).when(nxt > F.col("start"), nxt).otherwise(F.col("start") + least)
    return segments.withColumn("end", end)


def shared_times(pieces: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Start and end of the pieces of a segment (with start, end, piece), in proportion to their characters; the last ends with it."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    n, done, total = F.length("piece"), F.sum(F.length("piece")).over(w), F.sum(F.length("piece")).over(Window.partitionBy(*keys))
    span = F.col("end") - F.col("start")
    return pieces.withColumn("piece_start", F.col("start") + span * (done - n) / total).withColumn("piece_end", F.when(done == total, F.col("end")).otherwise(F.col("start") + span * done / total))


def block_text() -> Column:
    """The first of a block's texts that isn't blank: text, content, table and code bodies, equation, then its captions, a line each."""
    own = [F.trim(F.col(c)) for c in ("text", "content", "table_body", "code_body", "equation")]
    listed = [F.array_join(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""), "\n") for c in ("image_caption", "table_caption", "chart_caption")]
    filled = F.filter(F.array(*own, *listed), lambda x: x != "")
    return F.coalesce(F.get(filled, 0), F.lit(""))


def type_counts(elements: DataFrame, doc_col: str = "doc") -> DataFrame:
    """(doc, type, n)."""
    return elements.groupBy(doc_col, F.lower("type").alias("type")).agg(F.count("*").alias("n"))


def chosen_artifacts(files: DataFrame, wanted_stem: Column, preferred_parent: Column | None = None, by: str = "doc") -> DataFrame:
    """(doc, path): of each document's files, one in the preferred folder before others, then one of the wanted stem, of few parts, first by name."""
    parent, name = F.regexp_extract("path", "^(.*)/[^/]*$", 1), F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    apart = F.lit(1) if preferred_parent is None else F.when(parent == preferred_parent, 0).otherwise(1)
    score = F.struct(apart, F.when(stem == wanted_stem, 0).otherwise(1), F.size(F.split("path", "/")), F.col("path"))
    return files.groupBy(by).agg(F.min_by("path", score).alias("path"))


#: Keys under which a layout's nodes hold others.
CHILDREN = ("kids", "list items", "rows", "cells")


def flattened(layouts: DataFrame, doc_col: str = "doc", json_col: str = "layout") -> DataFrame:
    """(doc, index, type, page, content, source, bbox) of the nodes of nested layouts, parents first, in order.

    Nodes without type, content and source are passed through. A layout that is no JSON gives no row.
    """

    @F.pandas_udf("array<struct<type: string, page: int, content: string, source: string, bbox: array<double>>>")
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(_nodes)

    rows = layouts.select(doc_col, F.posexplode(walk(F.col(json_col))).alias("index", "e"))
    return rows.select(doc_col, "index", "e.*")


def _nodes(text: str | None) -> list[dict]:
    try:
        waiting = [json.loads(text or "null")]
    except ValueError:
        return []
    out = []
    while waiting:  # a stack: what is nested deeply needs no recursion
        node = waiting.pop()
        if isinstance(node, list):
            waiting.extend(reversed(node))
        elif isinstance(node, dict):
            content = " ".join(str(node.get("content") or "").split())
            kind, source = str(node.get("type") or "").lower(), node.get("source") or node.get("data")
            if kind or content or source:
                page, box = node.get("page number") or node.get("page"), node.get("bounding box") or node.get("bbox")
                good = isinstance(box, list) and all(isinstance(x, (int, float)) for x in box)
                out.append({"type": kind, "page": page if isinstance(page, int) else None, "content": content, "source": None if source is None else str(source), "bbox": list(map(float, box)) if good else None})
            waiting.extend(node[k] for k in reversed(CHILDREN) if node.get(k) is not None)
    return out

"""Decision tables: routing, validation, repair, and rules on images and captions, as conditional columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that ask for more than a quick answer; greetings; words of decorative pictures; marks of doubt in captions.
COMPARING = "比较|对比|审计|设计|方案|分别|compare|audit|design"
GREETING = r"(?i)^(?:你好|您好|嗨|谢谢|多谢|再见|hello|hi|thanks)[！!。.?？\s]*$"
NOISE = ("logo", "icon", "avatar", "decorative", "banner", "watermark", "brand")
DOUBT = ("cannot see", "can't see", "unable to", "not visible", "unclear", "no image", "i'm sorry", "as an ai")


def execution_mode(text: Column, first_turn: Column, forced: Column | None = None) -> Column:
    quick = first_turn & (F.length(text) < 180) & ~F.lower(text).rlike(COMPARING)
    return F.when(F.coalesce(forced, F.lit(False)) | quick if forced is not None else quick, "quick").otherwise("research")


def is_social(text: Column) -> Column:
    return text.rlike(GREETING)


def repair_decision(blocked: Column, items: Column, supported: Column, rounds: Column, evidence: Column, new_evidence: Column, wants_read: Column, wants_search: Column, searches: Column, max_rounds: int = 3, max_reads: int = 6, max_searches: int = 6) -> Column:
    """What follows an assessment; earlier rules win. items is null without a report."""
    return (
        F.when(blocked, "corpus_unavailable")
        .when(items.isNull(), "handoff_missing")
        .when(supported == items, "covered")
        .when(rounds >= max_rounds, "round_limit")
        .when((rounds > 1) & (new_evidence == 0), "no_progress")
        .when(evidence >= max_reads, "read_limit")
        .when(wants_read | wants_search & (searches < max_searches), "repair")
        .when(wants_search, "search_limit")
        .otherwise("partial_or_clarify")
    )


def report_status(status: Column, ids: Column, valid_ids: Column, gap: Column, next_action: Column) -> Column:
    """struct(status, gap, next_action) of a report's item; ids: how many pieces of evidence it names, valid_ids: how many of them were read.

    Claims need evidence, all of it read; only an inventory may say that the corpus lacks something; a supported item with
    a gap is partial; gaps in the output are answered and gaps in the conditions asked about.
    """
    unread = ((ids == 0) | (valid_ids < ids)) & status.isin("supported", "partial")
    missing = F.when(unread, "unknown").otherwise(gap) == "corpus_missing"
    gap_now = F.when(unread | missing, "unknown").otherwise(gap)
    status_now = F.when(unread | missing, "unsupported").when((status == "supported") & (gap_now != "none"), "partial").otherwise(status)
    action = F.when(gap_now == "output", "answer").when(gap_now == "conditions", "clarify").when(unread, "stop").otherwise(next_action)
    return F.struct(status_now.alias("status"), gap_now.alias("gap"), action.alias("next_action"))


#: Questions that name an interface, a version or an address.
EXACTING = r"(?i)API.{0,20}(?:参数|支持)|(?:版本|\bv)\s*\d|https?://"


def policy_route(question: Column, intent: Column, route: Column, knowledge_only: Column, scoped: Column, wants_scope: Column, matches: Column, preparation: Column, level: Column) -> Column:
    """struct(route, stop_reason) of a question.

    scoped: documents were chosen; wants_scope: the question names a source, matches: how many documents have it (null:
    none named). A scope that can't be told is asked about first; research waits for a corpus that is ready, and nothing
    else does.
    """
    lost = F.when(wants_scope & (matches == 0), "scope_missing").when(wants_scope & ((matches > 1) | (matches.isNull() & ~scoped)), "scope_ambiguous")
    found = F.coalesce(wants_scope & (matches == 1), F.lit(False))
    needs = knowledge_only | scoped | found | intent.isin("specific", "document") | question.rlike(EXACTING)
    needs = needs | ((level == "high") & (intent != "social") & (route != "clarify"))
    way = F.when(needs, "research").otherwise(route)
    waits = F.when((way == "research") & (preparation != "ready"), F.concat(F.lit("corpus_"), preparation))
    return F.struct(F.when(lost.isNotNull(), "clarify").otherwise(way).alias("route"), F.coalesce(lost, waits, F.lit("")).alias("stop_reason"))


def answer_policy(knowledge_only: Column, scoped: Column, level: Column) -> Column:
    """What an answer may rest on: strict (evidence read in this turn), free (marked guesses too) or marked (general knowledge as such)."""
    return F.when(knowledge_only | scoped | (level == "high"), "strict").when(level == "low", "free").otherwise("marked")


def bbox_metrics(elements: DataFrame, page_height: float = 792.0, margin: float = 72.0) -> DataFrame:
    """Adds area, longer over shorter side, and whether the box lies within the page's upper or lower margin; null (false) without four numbers."""
    b = F.when(F.size("bbox") >= 4, F.col("bbox"))
    at = lambda k: F.get(b, k)
    w, h = F.abs(at(2) - at(0)), F.abs(at(3) - at(1))
    edge = F.coalesce((at(1) >= page_height - margin) | (at(3) <= margin), F.lit(False))
    return elements.withColumn("area", w * h).withColumn("ratio", F.when(F.least(w, h) > 0, F.greatest(w, h) / F.least(w, h))).withColumn("at_edge", edge)


#: File endings of types that are no images.
OTHER_TYPES = r"(?i)\.(?:pdf|txt|html?|json|xml|csv|md|docx?|xlsx?|pptx?|zip|mp[34]|wav)$"


def image_skip(kind: Column, source: Column, has_file: Column, area: Column, ratio: Column, at_edge: Column, words: Column, context: Column, smallest: float = 4000.0, longest: float = 8.0) -> Column:
    """The first reason to leave an image out, or null. words: its own text and captions nearby; context: text around it.

    Images have the type image and a source; a null has_file is not looked for.
    """
    under = lambda times: F.coalesce(area < times * smallest, F.lit(False))
    return (
        F.when((kind != "image") | (F.coalesce(source, F.lit("")) == ""), "not_image")
        .when(~has_file, "image_file_missing")
        .when(source.rlike(OTHER_TYPES), "unsupported_mime")
        .when(under(1), "bbox_area")
        .when((ratio > longest) & under(3), "aspect_ratio_small_area")
        .when(at_edge & under(1.5), "page_edge_small_image")
        .when(F.lower(words).rlike("|".join(NOISE)) & (area.isNull() | under(3)), "noise_keyword_small_image")
        .when((F.length(F.trim(context)) < 40) & under(3), "sparse_context_small_area")
    )


#: Shortest caption that counts as one, and how captions of dry runs begin.
SHORTEST_CAPTION = 40
PLACEHOLDER = "DRY RUN CAPTION"


def caption_quality(caption: Column) -> Column:
    """Why a caption is poor, with the limit or the words that say so; empty if it is good."""
    text = F.lower(F.trim(F.regexp_replace(F.coalesce(caption, F.lit("")), r"^\s+|\s+$", "")))
    doubts = F.filter(F.array(*map(F.lit, DOUBT)), lambda m: F.contains(text, m))
    told = F.concat(F.lit("uncertainty_markers: "), F.array_join(doubts, ", "))
    return F.when(text == "", "empty").when(F.length(text) < SHORTEST_CAPTION, f"too_short(<{SHORTEST_CAPTION} chars)").when(F.size(doubts) > 0, told).otherwise("")


def is_placeholder(caption: Column) -> Column:
    return F.coalesce(F.startswith(caption, F.lit(PLACEHOLDER)), F.lit(False))

"""Product search: line windows ranked by words and, over the whole corpus, by vectors too; notes lead to what they cite.

Windows get their vectors from a vector table, which embeds only windows that it lacks. A search in a scope takes words
only: it never makes the table hold a part of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions.text import LETTER, bounded_lines, line_windows, word_tokens
from quarrylight.jobs.shared import written
from quarrylight.operators import dense, evidence, fusion, lexical
from quarrylight.operators.embedding import Embedder, embedded
from quarrylight.sources.vector_table import VectorTable, content_id

#: Candidates that each ranking gives to the fusion at least; hits of a document that come before others; notes' places in a result.
CANDIDATES, PER_DOCUMENT, NOTED = 20, 2, 2


def windows(docs: DataFrame, title: Column) -> DataFrame:
    """(doc_id, start_line, text, tokens): line windows with a letter in them, led by the title."""
    cut = docs.select("doc_id", title.alias("__title"), F.explode(line_windows(bounded_lines(F.col("text")))).alias("w"))
    rows = cut.select("doc_id", "__title", F.col("w.start_line").cast("long").alias("start_line"), F.array_join("w.lines", "\n").alias("s")).where(F.col("s").rlike(LETTER))
    tokens = word_tokens(F.concat(F.coalesce("__title", F.lit("")), F.lit(" "), F.col("s")))
    return lexical.with_tokens(rows.select("doc_id", "start_line", F.concat(F.coalesce("__title", F.lit("")), F.lit("\n"), F.col("s")).alias("text"), tokens.alias("t")), F.col("t")).drop("t")


def by_words(found: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The k best windows of each query among those that share a word with it: (item_id, doc_id, start_line, score, rank)."""
    scored = lexical.search(found.drop("text"), terms, True, k, id_cols=("doc_id", "start_line"))
    return lexical.top_k(scored, k, id_col=("doc_id", "start_line"))


def by_vectors(found: DataFrame, queries: DataFrame, table: VectorTable, k: int) -> DataFrame:
    """The k windows nearest to each query (item_id, text): (item_id, doc_id, start_line, score, rank). The table is brought up to date first."""
    named = found.select("doc_id", "start_line", "text", content_id(F.col("text"), F.col("doc_id"), F.col("start_line")).alias("id"))
    table.sync(named.select("id", "text"))
    place = F.concat_ws(":", F.lpad(F.col("doc_id").cast("string"), 19, "0"), F.lpad(F.col("start_line").cast("string"), 10, "0"))  # orders as the numbers do
    vectors = table.read().join(named.select("id", place.alias("place")), "id").select("place", "embedding")
    asked = queries.select("item_id", embedded(F.col("text"), table.embedder).alias("embedding"))
    near = dense.nearest(asked, vectors, k, id_col="place", query_col="item_id", include_self=True)
    part = F.split("place", ":")
    return near.select("item_id", part[0].cast("long").alias("doc_id"), part[1].cast("long").alias("start_line"), F.col("cosine").alias("score"), "rank")


def fused(words: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k best of both rankings by reciprocal ranks: (item_id, doc_id, start_line, score, rank)."""
    place = F.struct("doc_id", "start_line").alias("place")
    sides = [(side.select("item_id", place, "rank"), 1.0) for side in (words, vectors)]
    scored = fusion.reciprocal_ranks(sides, "item_id", "place").select("item_id", "place.*", "score")
    return lexical.top_k(scored, k, id_col=("doc_id", "start_line"), places=12)


def note_locators(notes: DataFrame, sources: DataFrame, documents: DataFrame, terms: DataFrame, allowed: DataFrame | None = None, most: int = NOTED) -> DataFrame:
    """(item_id, nth, doc_id, start_line): the first sources of reviewed, current notes that share a word with a query.

    notes: (note_id, title, body, reviewed); sources: (note_id, nth, doc_id, version, start_line); documents: (doc_id,
    version) of today; terms: (item_id, term). Notes are in the order of their ids. Only a note's first ``most`` sources
    and a word's first ``most`` sources can come among a query's first ones, so no word brings more than those rows.
    """
    states = evidence.note_states(notes.select("note_id").join(sources.select("note_id", "doc_id", "version"), "note_id", "left"), documents)
    good = notes.where("reviewed").join(states.where("state = 'current'").select("note_id"), "note_id", "left_semi")
    refs = sources if allowed is None else sources.join(allowed.select("doc_id").distinct(), "doc_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("note_id").orderBy("nth"))
    refs = refs.join(good.select("note_id"), "note_id", "left_semi").withColumn("__k", first).where(F.col("__k") <= most).select("note_id", "nth", "doc_id", "start_line")
    words = good.select("note_id", F.explode(F.array_distinct(word_tokens(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("body", F.lit("")))))).alias("term"))
    of_word = F.row_number().over(Window.partitionBy("term").orderBy("note_id", "nth"))
    led = words.join(refs, "note_id").withColumn("__k", of_word).where(F.col("__k") <= most).drop("__k")
    met = terms.select("item_id", "term").join(led, "term").select("item_id", "note_id", "nth", "doc_id", "start_line").distinct()
    of_query = F.row_number().over(Window.partitionBy("item_id").orderBy("note_id", "nth"))
    return met.withColumn("nth", of_query).where(F.col("nth") <= most).select("item_id", "nth", "doc_id", "start_line")


def with_notes(ranked: DataFrame, locators: DataFrame, k: int) -> DataFrame:
    """(item_id, doc_id, start_line, place, noted): locators first, then hits by place; k of each query."""
    front = locators.select("item_id", "doc_id", "start_line", F.lit(True).alias("noted"), F.col("nth").alias("__at"))
    rest = ranked.select("item_id", "doc_id", "start_line", F.lit(False).alias("noted"), F.col("place").alias("__at"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("noted"), "__at"))
    return front.unionByName(rest).withColumn("place", place).where(F.col("place") <= k).drop("__at")


def search(docs: DataFrame, title: Column, queries: DataFrame, limit: int = 6, table: VectorTable | None = None, scope: DataFrame | None = None, locators: DataFrame | None = None) -> DataFrame:
    """(item_id, doc_id, start_line, place, noted): the whole product search for queries (item_id, text).

    scope: (doc_id) of the documents that may be found; statistics are then those of the scope, and vectors are left
    aside. Queries without a word find nothing, notes neither. limit is held between 1 and 10.
    """
    limit = max(1, min(limit, 10))
    given = docs if scope is None else docs.join(scope.select("doc_id").distinct(), "doc_id", "left_semi")
    terms = lexical.query_terms(queries, word_tokens(F.col("text")))
    found = written(windows(given, title), "windows")  # cut into words once, read by every pass
    if table is None or scope is not None:
        scored = lexical.search(found.drop("text"), terms, True, PER_DOCUMENT + limit, id_cols=("doc_id", "start_line"), group_col="doc_id")
        ranked = lexical.diverse_top(scored, "doc_id", PER_DOCUMENT, limit, id_cols=("doc_id", "start_line"))
    else:
        k = max(CANDIDATES, 3 * limit)
        asked = queries.join(terms.select("item_id").distinct(), "item_id", "left_semi")
        ranked = lexical.diversified(fused(by_words(found, terms, k), by_vectors(found, asked, table, k), limit), "doc_id", PER_DOCUMENT, limit)
    none = queries.sparkSession.createDataFrame([], ranked.select("item_id", F.lit(1).alias("nth"), "doc_id", "start_line").schema)
    return with_notes(ranked, none if locators is None else locators, limit)

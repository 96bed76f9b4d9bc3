"""Binding questions to documents: the documents that a question allows, and the one that it names by id, title or origin.

A reference meets documents in one equality join: their ids, titles and origins are keys of one table, and a key is counted
before the join, so that a title that a third of all documents bear is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys(documents: DataFrame) -> DataFrame:
    """(key, n, doc_id): how many documents a text names, and the least of their ids."""
    named = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.array_distinct(F.array(F.col("doc_id").cast("string"), "title", "origin"))).alias("key"))
    return named.where("key is not null and key <> ''").groupBy("key").agg(F.countDistinct("doc_id").alias("n"), F.min("doc_id").alias("doc_id"))


def bind(questions: DataFrame, documents: DataFrame) -> DataFrame:
    """questions with stop_reason (scope_missing, scope_ambiguous, scope_conflict or null) and bound_doc_ids.

    questions: (question_id, reference, allowed_doc_ids: array or null, needs_scope, user_text); documents: (doc_id, title,
    origin). Ids that are allowed must all be there. A question that needs a scope must name a document that the user has
    named too (letters of either case), by a text that only one document bears and that is allowed; or, naming none, allow
    some. bound_doc_ids is that one document, else what was allowed.
    """
    there = documents.select(F.col("doc_id").cast("string").alias("__doc")).distinct()
    wanted = questions.where("size(allowed_doc_ids) > 0").select("question_id", F.explode(F.array_distinct("allowed_doc_ids")).alias("__doc"))
    lacking = wanted.join(there, "__doc", "left_anti").select("question_id").distinct().withColumn("__lacks", F.lit(True))
    met = keys(documents).select(F.col("key").alias("reference"), F.col("n").alias("__n"), F.col("doc_id").alias("__match"))
    rows = questions.join(lacking, "question_id", "left").join(met, "reference", "left")
    named = F.coalesce(F.col("reference"), F.lit("")) != ""
    spoken = F.contains(F.lower(F.coalesce("user_text", F.lit(""))), F.lower("reference"))
    some = F.coalesce(F.size("allowed_doc_ids") > 0, F.lit(False))
    needs, n = F.coalesce(F.col("needs_scope"), F.lit(False)), F.coalesce(F.col("__n"), F.lit(0))
    reason = (
        F.when(F.coalesce(F.col("__lacks"), F.lit(False)), "scope_missing")
        .when(~needs, None)
        .when(named & ~spoken, "scope_ambiguous")
        .when(named & (n == 0), "scope_missing")
        .when(named & (n > 1), "scope_ambiguous")
        .when(~named & ~some, "scope_ambiguous")
        .when(named & some & ~F.array_contains("allowed_doc_ids", F.col("__match")), "scope_conflict")
    )
    bound = F.when(reason.isNull() & needs & named, F.array("__match")).otherwise(F.col("allowed_doc_ids"))
    return rows.withColumn("stop_reason", reason).withColumn("bound_doc_ids", bound).select(*questions.columns, "stop_reason", "bound_doc_ids")

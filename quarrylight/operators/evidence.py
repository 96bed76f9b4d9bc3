"""Evidence against the documents it came from: validity, note states, repeated reads, reports and citation numbers, by joins on ids."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most questions that one report may hold.
MOST_ITEMS = 8


def validated(evidence: DataFrame, documents: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Adds valid: the document is still there in the version that was read, the text isn't blank, and the scope allows the document.

    evidence: (doc_id, version, text, ...); documents: (doc_id, version), one row each; allowed: (doc_id), or all.
    """
    current = documents.select("doc_id", F.col("version").alias("__now"))
    rows = evidence.join(current, "doc_id", "left")
    if allowed is not None:
        rows = rows.join(allowed.select("doc_id").distinct().withColumn("__may", F.lit(True)), "doc_id", "left")
    may = F.coalesce(F.col("__may"), F.lit(False)) if allowed is not None else F.lit(True)
    good = F.coalesce((F.col("__now") == F.col("version")) & F.col("text").rlike(r"\S"), F.lit(False)) & may
    return rows.withColumn("valid", good).drop("__now", "__may")


def note_states(notes: DataFrame, documents: DataFrame) -> DataFrame:
    """(note_id, state): unverified without sources, missing if one's document is gone, stale if one has another version, else current.

    notes: (note_id, doc_id, version), a row for each source and one with nulls for a note without any.
    """
    rows = notes.join(documents.select("doc_id", F.col("version").alias("__now")), "doc_id", "left")
    named = F.col("doc_id").isNotNull()
    sums = rows.groupBy("note_id").agg(F.count_if(named).alias("n"), F.count_if(named & F.col("__now").isNull()).alias("gone"), F.count_if(named & (F.col("__now") != F.col("version"))).alias("old"))
    return sums.select("note_id", F.when(F.col("n") == 0, "unverified").when(F.col("gone") > 0, "missing").when(F.col("old") > 0, "stale").otherwise("current").alias("state"))


def fresh_reads(reads: DataFrame) -> DataFrame:
    """Reads that no earlier kept read of the same run, document, page and version covers, by their first line.

    reads: (run_id, seq, doc_id, page, version, start_line, end_line). A run's reads of one page are few: runs have a reading limit.
    """

    def keep(rows: pd.DataFrame) -> pd.DataFrame:
        rows, kept = rows.sort_values("seq"), []
        for k, (start, end) in enumerate(zip(rows["start_line"], rows["end_line"])):
            if not any(a <= start <= b for _, a, b in kept):
                kept.append((k, start, end))
        return rows.iloc[[k for k, *_ in kept]]

    return reads.groupBy("run_id", "doc_id", "page", "version").applyInPandas(keep, reads.schema)


def cited(evidence: DataFrame, run_col: str = "run_id", order_col: str = "seq") -> DataFrame:
    """Adds citation: numbers from 1 in the order of a run's evidence."""
    return evidence.withColumn("citation", F.row_number().over(Window.partitionBy(run_col).orderBy(order_col)))


def _key(question: Column) -> Column:
    return F.lower(F.trim(question))


def merged_reports(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(run_id, place, question, ...): a run's questions of both reports, those asked again as answered last, at their first place.

    Both: (run_id, place, question, ...). A run whose questions are more than MOST_ITEMS together has no report.
    """
    first = previous.withColumn("__round", F.lit(0)).unionByName(current.withColumn("__round", F.lit(1)))
    keyed = first.withColumn("__key", _key(F.col("question")))
    same = Window.partitionBy("run_id", "__key")
    latest = keyed.withColumn("__at", F.min(F.struct("__round", "place")).over(same)).withColumn("__last", F.row_number().over(same.orderBy(F.desc("__round"), F.desc("place")))).where("__last = 1")
    sized = latest.withColumn("__n", F.count("*").over(Window.partitionBy("run_id"))).where(F.col("__n") <= MOST_ITEMS)
    return sized.withColumn("place", F.row_number().over(Window.partitionBy("run_id").orderBy("__at")) - 1).drop("__round", "__key", "__at", "__last", "__n")


def with_blocked(items: DataFrame, blocked: DataFrame) -> DataFrame:
    """Reports (run_id, question, status, gap, next_action, detail) with what an inventory has found missing (run_id, question or null, source) in place of its own item."""
    lacking = blocked.select("run_id", F.coalesce("question", "source").alias("question"), F.lit("unsupported").alias("status"), F.lit("corpus_missing").alias("gap"), F.lit("stop").alias("next_action"), F.col("source").alias("detail"))
    return items.join(lacking.select("run_id", "question"), ["run_id", "question"], "left_anti").select(*lacking.columns).unionByName(lacking)

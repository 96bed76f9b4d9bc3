"""Quick verification: the two best hits of a question are read at once, as the evidence that one answer must rest on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.operators.reading import read_lines

#: Fixed value: questions that ask what a document is about.
OVERVIEW = r"(?i)定位|是什么|概述|what is|overview"


def first_reads(questions: DataFrame, hits: DataFrame, documents: DataFrame) -> DataFrame:
    """(question_id, nth, doc_id, start_line, lines_read, chars_read, next_start_line, text): up to two reads of each question.

    questions: (question_id, question); hits: (question_id, rank from 1, doc_id, start_line); documents: (doc_id, text),
    one row each. A read starts at its hit's line; of an overview whose hits lie all in one document the first starts at
    line 1 and the second goes on where that ended, if anything is left. Lines that a document lacks give no read, and a
    read that repeats the first is left out.
    """
    spread = hits.groupBy("question_id").agg(F.min("doc_id").alias("__a"), F.max("doc_id").alias("__b"))
    asked = questions.join(spread, "question_id").select("question_id", (F.coalesce(F.col("question").rlike(OVERVIEW), F.lit(False)) & (F.col("__a") == F.col("__b"))).alias("whole"))

    def hit(n: int) -> DataFrame:
        return hits.where(F.col("rank") == n).select("question_id", "doc_id", "start_line").join(asked, "question_id").join(documents.select("doc_id", "text"), "doc_id")

    def read(rows: DataFrame, start, nth: int) -> DataFrame:
        found = read_lines(rows, start, id_col="question_id")
        return rows.select("question_id", "doc_id", "whole").join(found, "question_id").withColumn("nth", F.lit(nth))

    one = read(hit(1), F.when(F.col("whole"), 1).otherwise(F.col("start_line")), 1)
    before = one.select("question_id", F.col("start_line").alias("__first"), F.col("doc_id").alias("__doc"), "next_start_line")
    rest = hit(2).join(before, "question_id", "left")
    went_on = F.col("whole") & F.col("__first").isNotNull()
    start = F.when(went_on, F.col("next_start_line")).otherwise(F.col("start_line"))
    rest = rest.withColumn("__start", start).where("__start is not null").where(~((F.col("__start") == F.col("__first")) & (F.col("doc_id") == F.col("__doc"))) | F.col("__first").isNull())
    both = one.unionByName(read(rest.drop("start_line", "next_start_line"), F.col("__start"), 2))
    return both.select("question_id", "nth", "doc_id", "start_line", "lines_read", "chars_read", "next_start_line", "text")

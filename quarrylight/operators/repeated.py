"""Searches that repeat: questions are grouped by what they ask, asked once, and each gets its answers back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.jobs.shared import written


def search_key(text: Column) -> Column:
    """Lower case, single blanks, no blanks around."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def budgeted(questions: DataFrame, budget: int, run_col: str = "run_id", order_col: str = "seq", text_col: str = "text") -> DataFrame:
    """questions with key, cached (the run has asked the same before) and refused (the run's budget of different searches is used up)."""
    keyed = questions.withColumn("key", search_key(F.coalesce(F.col(text_col), F.lit(""))))
    first = keyed.groupBy(run_col, "key").agg(F.min(order_col).alias("__first"))
    nth = F.row_number().over(Window.partitionBy(run_col).orderBy("__first", "key"))
    rows = keyed.join(first.withColumn("__nth", nth), [run_col, "key"])
    refused = F.col("__nth") > budget
    return rows.withColumn("refused", refused).withColumn("cached", ~refused & (F.col(order_col) > F.col("__first"))).drop("__first", "__nth")


def answered(questions: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(questions, answers of search): search gets (key, text), a row for each different key that is not refused, in one call.

    Its rows must carry key; those of a key go to all questions that ask it. Questions without answers stay, with nulls.
    """
    asked = written(questions.where(~F.col("refused")).select("key").distinct().withColumn("text", F.col("key")), "asked")
    found = search(asked)
    return questions.join(found.withColumn("refused", F.lit(False)), ["key", "refused"], "left")

"""Experiment matrices: what each run retrieved against gold chunks and images, its context, and the summary of each variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The type of caption chunks, image marks inside texts, the headers of evidence, and what stands for none.
CAPTION = "image_caption"
INLINE_IMAGE = r"\[Image\s+id=(imgcap-\d+)"
NO_EVIDENCE = "(no evidence retrieved)"
VARIANT = ("strategy", "retrieval", "alpha")


def evidence_block(rank: Column) -> Column:
    """A hit (chunk_id, chunk_type, image_id, image_path, page, text) as a block of the context."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?"))
    path = F.when(F.coalesce("image_path", F.lit("")) != "", F.concat(F.lit(" path="), "image_path")).otherwise("")
    n = rank.cast("string")
    image = F.concat(F.lit("[Image evidence #"), n, F.lit("] id="), F.coalesce(F.col("image_id").cast("string"), shown("chunk_id")), F.lit(" page="), shown("page"), path)
    text = F.concat(F.lit("[Text evidence #"), n, F.lit("] id="), shown("chunk_id"), F.lit(" page="), shown("page"))
    return F.concat(F.when(F.col("chunk_type") == CAPTION, image).otherwise(text), F.lit("\n"), F.coalesce("text", F.lit("")))


def contexts(hits: DataFrame, by: list[str], budget: int | None = None, after: Column | int = 0) -> DataFrame:
    """(by, context, blocks, chars, next_after): blocks in the order of rank with an empty line between them.

    With a budget of characters, whole blocks are taken while they and the empty lines fit; next_after is the rank to go on
    after (``after`` of the next call), null at the end. A first block over the budget is taken alone, so that reading goes
    on. Only ranks after ``after`` count; numbers in the blocks are those of the ranks.
    """
    after = F.lit(after) if isinstance(after, int) else after
    rest = hits.where(F.col("rank") > after).withColumn("__b", evidence_block(F.col("rank")))
    order = Window.partitionBy(*by).orderBy("rank")
    size = F.sum(F.length("__b").cast("long") + 2).over(order) - 2
    measured = rest.withColumn("__size", size).withColumn("__nth", F.row_number().over(order))
    fits = F.lit(True) if budget is None else (F.col("__size") <= budget) | (F.col("__nth") == 1)
    marked = measured.withColumn("__in", fits)
    blocks = F.transform(F.array_sort(F.collect_list(F.when(F.col("__in"), F.struct("rank", "__b")))), lambda x: x["__b"])
    last = F.max(F.when(F.col("__in"), F.col("rank")))
    out = marked.groupBy(*by).agg(F.array_join(blocks, "\n\n").alias("context"), F.count_if("__in").alias("blocks"), F.max(F.when(F.col("__in"), F.col("__size"))).alias("chars"), F.when(F.count_if(~F.col("__in")) > 0, last).alias("next_after"))
    return out


def run_metrics(runs: DataFrame, hits: DataFrame, cases: DataFrame) -> DataFrame:
    """What each run (case_id, strategy, retrieval, alpha) found, a row each, also of runs without hits.

    hits: those columns, rank, and those of evidence_block(); cases: (case_id, gold_chunk_ids, gold_image_ids). A hit that
    is a caption counts as its image; images named inside of texts count too. Gold hits are false without gold.
    """
    key = ["case_id", *VARIANT]
    inline = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(INLINE_IMAGE), F.lit(1))
    is_image = F.coalesce(F.col("chunk_type") == CAPTION, F.lit(False))
    own = F.when(is_image, F.coalesce(F.col("image_id").cast("string"), F.col("chunk_id").cast("string")))
    told = hits.withColumn("__i", F.array_compact(F.concat(F.array(own), inline))).withColumn("__n", F.size(inline))
    found = told.groupBy(*key).agg(
        F.count("*").alias("hits"),
        F.count_if(is_image).alias("image_evidence_count"),
        F.sum("__n").cast("long").alias("inline_image_mention_count"),
        F.sum(F.length(evidence_block(F.col("rank"))).cast("long") + 2).alias("__chars"),
        F.array_sort(F.collect_set(F.col("chunk_id").cast("string"))).alias("retrieved_chunk_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__i")))).alias("retrieved_image_ids"),
    )
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    rows = runs.select(*key).join(cases, "case_id").join(found, key, "left")
    count = lambda c: F.coalesce(c, zero).alias(c)
    rows = rows.select(*key, "gold_chunk_ids", "gold_image_ids", count("hits"), count("image_evidence_count"), count("inline_image_mention_count"), "__chars", *(F.coalesce(c, none).alias(c) for c in ("retrieved_chunk_ids", "retrieved_image_ids")))
    meet = lambda gold, got: F.size(F.array_intersect(F.coalesce(gold, none), got)).cast("long")
    rows = rows.withColumn("gold_chunk_hit_count", meet("gold_chunk_ids", "retrieved_chunk_ids")).withColumn("gold_image_hit_count", meet("gold_image_ids", "retrieved_image_ids"))
    return rows.select(
        "*",
        (F.col("gold_chunk_hit_count") > 0).alias("gold_chunk_hit"),
        (F.col("gold_image_hit_count") > 0).alias("gold_image_hit"),
        (F.col("image_evidence_count") + F.col("inline_image_mention_count")).alias("image_reference_count"),
        F.when(F.col("hits") > 0, F.round(F.col("image_evidence_count") / F.greatest("hits", F.lit(1)), 4)).otherwise(0.0).alias("image_evidence_ratio"),
        F.coalesce(F.col("__chars") - 2, F.lit(len(NO_EVIDENCE)).cast("long")).alias("context_chars"),
    ).drop("__chars")


def matrix(metrics: DataFrame) -> DataFrame:
    """A row for each variant: runs, means, and recall of gold images and chunks over the cases that have any, null if none has."""
    mean = lambda c, places=4: F.round(F.avg(F.col(c)), places).alias(f"avg_{c}")
    recall = lambda kind: F.round(F.avg(F.when(F.size(F.coalesce(f"gold_{kind}_ids", F.array().cast("array<string>"))) > 0, F.col(f"gold_{kind}_hit").cast("double"))), 4).alias(f"gold_{kind}_recall_at_k")
    return metrics.groupBy(*VARIANT).agg(F.count("*").alias("runs"), F.countDistinct("case_id").alias("cases"), mean("image_evidence_count"), mean("inline_image_mention_count"), mean("image_reference_count"), mean("context_chars", 2), recall("image"), recall("chunk"))

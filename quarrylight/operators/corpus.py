"""Corpus keeping: versions, upserts, index synchronisation, audits, copies and chunk statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.functions.text import short_hash


def versions(docs: DataFrame, origin: Column, content: Column) -> DataFrame:
    """Adds key (of the origin) and version (of the content), 20 hex digits each."""
    return docs.withColumn("key", short_hash(origin, 20)).withColumn("version", short_hash(content, 20))


def upsert(stored: DataFrame, arriving: DataFrame, content_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(stored after, report): rows by key; arrivals replace what is stored, blank ones are refused.

    report: key, version, changed (new or of another version), refused.
    """
    blank = F.coalesce(F.col(content_col), F.lit("")).rlike(r"^\s*$")
    good = arriving.where(~blank)
    after = stored.join(good.select("key"), "key", "left_anti").unionByName(good.select(*stored.columns))
    old = stored.select("key", F.col("version").alias("__old"))
    report = arriving.withColumn("refused", blank).join(old, "key", "left")
    return after, report.select("key", "version", (~F.col("version").eqNullSafe(F.col("__old")) & ~F.col("refused")).alias("changed"), "refused")


def index_changes(indexed: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(key, action): add what the index lacks, delete what it no longer should hold."""
    add = wanted.select(key).distinct().join(indexed.select(key), key, "left_anti").select(key, F.lit("add").alias("action"))
    return add.unionByName(indexed.select(key).distinct().join(wanted.select(key), key, "left_anti").select(key, F.lit("delete").alias("action")))


def audit(docs: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """Per group: files, bytes, chars, whether all are non-empty, distinct contents."""
    return docs.groupBy(group_col).agg(
        F.count("*").alias("files"),
        F.sum(F.octet_length(text_col).cast("long")).alias("bytes"),
        F.sum(F.length(text_col).cast("long")).alias("chars"),
        F.bool_and(F.length(text_col) > 0).alias("all_filled"),
        F.countDistinct(F.sha2(text_col, 256)).alias("contents"),
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sha, copies, first, last) of contents that occur more than once."""
    sums = docs.select(id_col, F.sha2(text_col, 256).alias("sha"))
    return sums.groupBy("sha").agg(F.count("*").alias("copies"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")).where("copies > 1")


def chunk_statistics(chunks: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    n = F.length(text_col).cast("long")
    return chunks.groupBy(group_col).agg(F.count("*").alias("chunks"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.round(F.avg(n), 2).alias("mean_chars"))

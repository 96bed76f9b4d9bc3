"""Exact deduplication by progressive refinement, in DataFrame functions only.

Texts are equal when they are identical after each run of white space became one blank. Rows are counted by the length
of that text; lengths that recur are counted by a hash of the first characters; only rows whose length and prefix hash
both recur are open, and only open rows get a full hash. Only narrow keys are shuffled, never texts.

Which keys are open is told to the scan of texts by a bit table of fixed size (BITS bits, at most 16 MB), at every size
of the input alike. A bit that another key has set opens a row in vain and costs one full hash, never a result.

Defined cases: a null text counts as empty; of equal texts the row with the smallest id stays, ids that are null come
last; of rows that repeat id and text one stays; an empty table gives an empty result; input columns besides the two
named are neither read nor returned by ``groups``, and all returned unchanged by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bit_of, bit_table, documents, materialize, renamed, spread_join, text_or_empty, with_bit

#: Most keys (of some 16 bytes) that are broadcast; beyond that the same join shuffles narrow rows.
BROADCAST_KEYS = 200_000


def normalised(text_col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]+", " ")


def is_small(df: DataFrame, bound: int = BROADCAST_KEYS) -> bool:
    return df.limit(bound + 1).count() <= bound


def small(df: DataFrame, bound: int = BROADCAST_KEYS) -> DataFrame:
    """Marks a table for broadcast if it has been counted and found small enough; a shuffle join serves otherwise."""
    return F.broadcast(df) if is_small(df, bound) else df


def _sketch(text: Column, prefix_chars: int) -> list[Column]:
    return [F.length(text).alias("__n"), F.xxhash64(F.substring(text, 1, prefix_chars)).alias("__prefix")]


def open_keys(docs: DataFrame, text_col: str, prefix_chars: int) -> DataFrame:
    """(bucket, bits): the bit table of (length, prefix hash) pairs that more than one row has."""
    pairs = docs.select(*_sketch(normalised(text_col), prefix_chars)).groupBy("__n", "__prefix").agg(F.count("*").alias("c"))
    pairs = materialize(pairs, "exact-keys")
    lengths = pairs.groupBy("__n").agg(F.sum("c").alias("rows"), F.count("*").alias("pairs")).where("rows > 1").select("__n", "pairs")
    again = spread_join(pairs, materialize(lengths, "exact-lengths"), ["__n"], "pairs").where("c > 1")
    return materialize(bit_table(again, bit_of("__n", "__prefix")), "exact-open")


def with_digests(docs: DataFrame, text_col: str, prefix_chars: int, every: bool = False) -> DataFrame:
    """Adds __sha, the full hash of rows that are open (null for others; taken of all with ``every``), and __open."""
    table = open_keys(docs, text_col, prefix_chars)
    rows = docs.withColumn("__t", normalised(text_col))
    rows = with_bit(rows.select("*", *_sketch(F.col("__t"), prefix_chars)), table, "__open", "__n", "__prefix")
    sha = F.sha2("__t", 256)
    return rows.select(*docs.columns, "__open", (sha if every else F.when(F.col("__open"), sha)).alias("__sha"))


def _decided(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct __id and __sha of open rows with their number __m, (__sha, keep_id, group_size))."""
    repeats = materialize(rows.where("__open").groupBy("__id", "__sha").agg(F.count("*").alias("__m")), "exact-repeats")
    totals = repeats.groupBy("__sha").agg(F.min("__id").alias("keep_id"), F.sum("__m").alias("group_size"))
    return repeats, materialize(totals, "exact-groups")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, all_digests: bool = True) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row for each input row, dropped ones too.

    Without all_digests, text_sha256 is null where length and prefix hash alone tell a text from all others.
    """
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = materialize(with_digests(narrow, "__text", prefix_chars, all_digests).drop("__text"), "exact-rows")
    repeats, totals = _decided(rows)
    grouped = spread_join(repeats, totals, ["__sha"], "group_size").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__m").cast("int"))))
    kept = F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 1)
    out = grouped.select(F.col("__id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.col("__sha").alias("text_sha256"))
    alone = rows.where("not __open").select(F.col("__id").alias(id_col), F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("__sha").alias("text_sha256"))
    return alone.unionByName(out)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64) -> DataFrame:
    """The rows of docs that stay, with all their columns. Rows that are not open stay without a full hash."""
    columns, plain = docs.columns, renamed(docs)
    id_, text = plain.columns[columns.index(id_col)], plain.columns[columns.index(text_col)]
    digested = with_digests(plain, text, prefix_chars)
    rows = digested.select(F.col(id_).alias("__id"), "__open", "__sha")
    repeats, totals = _decided(rows)
    named = spread_join(repeats, totals, ["__sha"], "group_size").where("group_size > 1")
    decided = materialize(named.select("__id", "__sha", F.col("__id").eqNullSafe(F.col("keep_id")).alias("__stays"), "__m"), "exact-decided")
    gone = decided.where("not __stays").select("__id", F.col("__sha").alias("__gone"))
    repeated = decided.where("__stays and __m > 1").select("__id", F.col("__sha").alias("__gone"))
    here = lambda ids: F.col(id_).eqNullSafe(ids["__id"]) & (F.col("__sha") == ids["__gone"])
    if repeated.isEmpty():
        gone = small(gone)
        return digested.join(gone, here(gone), "left_anti").select(*plain.columns).toDF(*columns)
    rest, once = small(gone.unionByName(repeated)), small(repeated)
    one_each = digested.join(once, here(once), "left_semi").dropDuplicates([id_, "__sha"])
    return digested.join(rest, here(rest), "left_anti").unionByName(one_each).select(*plain.columns).toDF(*columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

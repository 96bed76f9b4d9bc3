"""What the operators of this subpackage share: shared-folder tables, worker caches, text segments."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.jobs.shared import is_local, root_folder

_OWN_DIR: str | None = None
_CLEANED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where that is unset: a folder of its own if the driver runs all tasks itself (local mode, as in tests), else the
    warehouse, which must lie in a store that executors share; one on each machine's own disk is an error.
    """
    global _OWN_DIR
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or not is_local(spark.sparkContext.master):
        return root_folder(spark).rstrip("/")
    if _OWN_DIR is None:
        _OWN_DIR = root_folder(spark)
    return _OWN_DIR


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a working table below the shared folder; all of them go when the driver ends."""
    root = f"{shared_dir(spark)}/quarrylight-{spark.sparkContext.applicationId}"
    if root not in _CLEANED:
        _CLEANED.add(root)

        def clean() -> None:
            try:
                delete_path(spark, root)
            except Exception:  # the JVM may be gone before this hook runs; the folder then stays
                pass

        atexit.register(clean)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Documents are long: smaller Arrow batches bound what a Python worker and its JVM hold at once. Keeps a smaller setting."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet in the shared folder and reads it back, so lost executors cost no recomputation."""
    spark = df.sparkSession
    modest_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a table that materialize() wrote and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/quarrylight-" in folder:
            delete_path(spark, folder)


def renamed(df: DataFrame) -> DataFrame:
    """df with columns c0, c1, ...: names that nothing an operator adds can clash with. ``toDF(*df.columns)`` gives them back."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


#: Keys that hold more than one row in so many, and more than so many rows, are joined by broadcast; there can be no more of them than SHARE.
SHARE, FEW = 10_000, 1000


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], count_col: str, how: str = "inner") -> DataFrame:
    """rows joined with table, whose rows hold a key each and, in count_col, how many rows it has.

    A key with more than 1/SHARE of all rows is hot. There are at most SHARE of those, so they are broadcast and their
    rows stay where they are; the others shuffle, and no task gets more than that share of rows for one key.
    """
    total, most = table.agg(F.sum(count_col), F.max(count_col)).first()
    limit = max(FEW, (total or 0) // SHARE)
    if (most or 0) <= limit:
        return rows.join(table, keys, how)
    hot = table.where(F.col(count_col) > limit)
    near = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.where(F.col(count_col) <= limit), keys, how)
    return near.unionByName(rest)


#: Size of a bit table, whatever the input's size: 16 MB.
BITS = 1 << 27


def bit_table(bits: DataFrame, bit: Column) -> DataFrame:
    """(bucket, bits): a bit table with the given bits, numbered from 0 and below BITS, set."""
    numbered = bits.select((bit + 1).alias("bit"))
    return numbered.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))


def bit_of(*key: str) -> Column:
    """A key's bit, below BITS."""
    return F.pmod(F.xxhash64(*key), F.lit(BITS))


def with_bit(rows: DataFrame, table: DataFrame, name: str, *key: str) -> DataFrame:
    """Adds whether the table has the bit of a row's key set: true for keys that it was made of, and for a few others by chance."""
    found = rows.withColumn("__bit", bit_of(*key) + 1).withColumn("bucket", F.bitmap_bucket_number("__bit"))
    found = found.join(F.broadcast(table), "bucket", "left").withColumn("__at", F.bitmap_bit_position("__bit").cast("int"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.call_function("shiftright", byte, F.col("__at") % 8).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return found.select(*rows.columns, is_set.alias(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: White space next to a blank: only there may a blank that starts a segment belong to a longer white-space match.
_WIDE_BLANK = re.compile(r"(?<=\s) | (?=\s)")


def blank_segments(text: str) -> list[str] | None:
    """Splits a text before each single blank, or None if a blank touches other white space.

    Patterns whose matches hold a blank only as their first character never cross such a cut,
    so what they find in the segments, joined, is what they find in the text.
    """
    parts = text.split(" ")
    if len(parts) == 1:
        return parts if text else []
    if "" in parts[1:-1] or _WIDE_BLANK.search(text):
        return None
    out = [" " + p for p in parts]
    out[0] = parts[0]
    return out if parts[0] else out[1:]


def text_batches(batches: Iterable, rows: int = 2000) -> Iterator:
    """Record batches of at most so many rows, so that a batch of long texts stays small in Python."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # workers are used again; what Arrow holds back would add up

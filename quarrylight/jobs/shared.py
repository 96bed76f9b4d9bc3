"""Folders that the driver and all executors see."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset: a local one if the driver runs all tasks itself, else the warehouse
    if it lies in a store that executors share; a warehouse on the machine's own disk is refused, since rows would be lost there."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if is_local(spark.sparkContext.master):
        return "file://" + tempfile.mkdtemp(prefix="quarrylight-")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if on_own_disk(warehouse):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share: the warehouse {warehouse} lies on each machine's own disk")
    return warehouse


def is_local(master: str) -> bool:
    """Whether tasks run in the driver: local, local[n]; not local-cluster."""
    return master.split("[")[0] == "local"


def on_own_disk(path: str) -> bool:
    return path.startswith(("/", "file:")) or ":/" not in path


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the root folder. It goes when the driver ends."""
    root = root_folder(spark)
    path = f"{root.rstrip('/')}/quarrylight-{name}-{uuid.uuid4().hex[:12]}"

    def clean() -> None:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the JVM may be gone before this hook runs; the folder then stays
            pass

    atexit.register(clean)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in a folder of its own, read back: made once, whatever reads it, and safe from lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

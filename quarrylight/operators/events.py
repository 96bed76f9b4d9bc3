"""Run events: ledgers, reducers, stage times and windows. The same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_times(events: DataFrame) -> DataFrame:
    """(run, phase, n, total): sums by run and phase."""
    return events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def usage_ledger(events: DataFrame) -> DataFrame:
    """Per run: calls, those that report a counter, and the counter's total, null unless all have reported."""
    k = F.get_json_object("props", "$.k").cast("long")
    agg = events.groupBy("user_id").agg(F.count("*").alias("calls"), F.count(k).alias("reported"), F.sum(k).alias("s"))
    return agg.select("user_id", "calls", "reported", F.when(F.col("calls") == F.col("reported"), F.col("s")).alias("total"))


def reduced(events: DataFrame) -> DataFrame:
    """Per run: last phase and value by event order, first time, whether the run has ended (its last phase is a purchase)."""
    order = F.struct("ts", "event_id")
    agg = events.groupBy("user_id").agg(F.max_by("event_type", order).alias("last_phase"), F.max_by("value", order).alias("last_value"), F.min("ts").alias("began"), F.max("ts").alias("ended"), F.countDistinct("event_type").alias("phases"))
    return agg.withColumn("seconds", F.floor((F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("began").cast("timestamp"))) / 1000000)).drop("ended", "began")


def windowed(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(begin, phase, n, total) in tumbling windows; late rows within the watermark still count in a stream."""
    w = F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("begin"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user, begin, n): a session ends after a gap."""
    s = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(s, "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("begin"), "n")

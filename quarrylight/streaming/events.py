"""Streaming jobs over run events: windows, sessions and a stateful reducer of each run's steps."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at path (a file or a folder)."""
    schema = spark.read.parquet(path).schema
    name = path.rstrip("/").rsplit("/", 1)
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path if not name[1].endswith(".parquet") else f"{name[0]}/{name[1].replace('.parquet', '.parque[t]')}")


def drain(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs a stream over what is there, to Parquet, and returns what it wrote. Restarts go on from the checkpoint."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def step_states(events: DataFrame, timeout_ms: int | None = 180_000, late: str | None = None) -> DataFrame:
    """(run, steps, last_phase, status): each run's state after each micro-batch; runs without news for timeout_ms are interrupted
    (None: never, for streams that end).

    An event that arrives again, in the same or a later micro-batch, counts once, and one that arrives late counts like
    any other: what has been seen is state of the stream's own, keyed by run and event, not of a run's group. ``late``
    bounds that state: events more than so much behind the newest are then forgotten, and dropped.
    """
    key = ["user_id", "event_id"]
    events = events.dropDuplicates(key) if late is None else events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)

    def update(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps, last_id, phase = state.get if state.exists else (0, -1, "")
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "steps": [steps], "last_phase": [phase], "status": ["interrupted"]})
            return
        for rows in frames:  # a large group comes in several frames, in no order
            if len(rows):
                steps += len(rows)
                top = rows["event_id"].idxmax()
                if rows["event_id"][top] > last_id:
                    last_id, phase = int(rows["event_id"][top]), str(rows["event_type"][top])
        state.update((steps, last_id, phase))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame({"user_id": [key[0]], "steps": [steps], "last_phase": [phase], "status": ["running"]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, steps long, last_phase string, status string", "steps long, last_id long, phase string", "append", GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout)

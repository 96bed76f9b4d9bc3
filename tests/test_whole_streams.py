"""Streams whose groups exceed one Arrow batch."""

import os
import random
import time

from quarrylight.streaming import events as streams


def test_steps_of_groups_in_several_frames(spark, tmp_path):
    rows = [(k, 1 if k % 3 else 2, f"e{k}") for k in range(60)]
    rows += rows[:7]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").repartition(5).write.parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        out = streams.drain(streams.step_states(streams.read(spark, f"{tmp_path}/in"), None), f"{tmp_path}/out", f"{tmp_path}/state")
        got = {r.user_id: (r.steps, r.last_phase) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {1: (40, "e59"), 2: (20, "e57")}


def test_late_events_count_and_repeated_ones_do_not(spark, tmp_path):
    """Two micro-batches, the second with smaller ids and one event again."""
    batches = [[(10, 1, "view"), (12, 1, "click"), (5, 2, "view")], [(11, 1, "late"), (3, 1, "later"), (12, 1, "click"), (6, 2, "buy")]]
    states = lambda: streams.step_states(streams.read(spark, f"{tmp_path}/in"), None)
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "event_id long, user_id long, event_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = streams.drain(states(), f"{tmp_path}/out", f"{tmp_path}/state")
    got = {(r.user_id, r.steps): r.last_phase for r in out.collect()}
    assert got == {(1, 2): "click", (2, 1): "view", (1, 4): "click", (2, 2): "buy"}


def test_runs_without_news_are_interrupted(spark, tmp_path):
    """A stream that goes on: the timeout fires in a later micro-batch, also without new events."""
    spark.createDataFrame([(1, 1, "view"), (2, 1, "click")], "event_id long, user_id long, event_type string").coalesce(1).write.parquet(f"{tmp_path}/in")
    states = streams.step_states(streams.read(spark, f"{tmp_path}/in"), 1)
    query = states.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="1 second").start()
    try:
        got, until = set(), time.time() + 60
        while len(got) < 2 and time.time() < until:
            time.sleep(1)
            if os.path.isdir(f"{tmp_path}/out/_spark_metadata"):
                got = {tuple(r) for r in spark.read.schema(states.schema).parquet(f"{tmp_path}/out").collect()}
    finally:
        query.stop()
    assert got == {(1, 2, "click", "running"), (1, 2, "click", "interrupted")}

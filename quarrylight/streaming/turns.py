"""Answer streams: bytes of server-sent frames, cut anywhere, become the state of each run's turn.

A chunk is (run_id, seq, at_ms, bytes): seq counts a run's chunks from 0, at_ms is the time since the run began. Frames end
at an empty line; what comes after the last one waits in the run's state for the next chunk, and so does a chunk that
comes before its turn. A chunk that comes again counts once. How a stream is cut, dealt into micro-batches and ordered
within them changes nothing in the last state of a run.
"""

from __future__ import annotations

import base64
import json
import warnings
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Events that a turn takes, and what is said of a stream that ends early.
TAKEN = ("status", "sources", "token", "done", "policy", "telemetry", "usage", "step")
NOT_DONE, BROKEN = "answer not completed", "connection broken before the answer was complete"

STEP = "struct<id: string, phase: string, status: string, label: string>"
TURN = f"run_id string, frames long, outcome string, answer string, first_token_ms long, total_ms long, reported_calls long, usage string, policy string, telemetry string, sources string, steps array<{STEP}>, error string"


def frames(buffer: bytes) -> tuple[list[bytes], bytes]:
    """Complete frames, and the bytes after the last one. The mark between frames never lies inside a character."""
    *whole, rest = buffer.split(b"\n\n")
    return whole, rest


def event_of(frame: bytes) -> tuple[str, str] | None:
    """(event, data) of a frame, or None if it lacks either."""
    lines = frame.decode("utf-8", "replace").split("\n")
    name = next((line[6:].strip() for line in lines if line.startswith("event:")), "")
    data = "\n".join(line[5:].lstrip() for line in lines if line.startswith("data:"))
    return (name, data) if name and data else None


def new_turn() -> dict:
    return {"frames": 0, "outcome": "running", "answer": "", "first_token_ms": None, "total_ms": None, "usage": None, "policy": None, "telemetry": None, "sources": None, "steps": [], "error": None}


def failed(turn: dict, why: str) -> None:
    """Ends a running turn; its running steps are interrupted."""
    turn["outcome"], turn["error"] = "failed", why
    turn["steps"] = [s | {"status": "interrupted"} if s.get("status") == "running" else s for s in turn["steps"]]


def receive(turn: dict, run_id: str, name: str, data: str, at_ms: int) -> None:
    """Takes one event into a turn that is running."""
    try:
        told = json.loads(data)
    except ValueError:
        return failed(turn, f"unreadable data of {name}")
    told = told if isinstance(told, dict) or name == "sources" else {}
    if name == "error":
        failed(turn, str(told.get("message")))
    elif name == "done":
        if told.get("ok"):
            turn["outcome"], turn["total_ms"] = "completed", at_ms
        else:
            failed(turn, NOT_DONE)
    elif name == "step" and told.get("run_id") == run_id:
        at = next((k for k, s in enumerate(turn["steps"]) if s.get("id") == told.get("id")), len(turn["steps"]))
        turn["steps"][at : at + 1] = [told]
    elif name == "usage" and told.get("run_id") in (None, "", run_id):
        if not (turn["usage"] and (turn["usage"].get("reported_calls") or 0) > (told.get("reported_calls") or 0)):
            turn["usage"] = told
    elif name == "token" and told.get("text"):
        turn["answer"] += str(told["text"])
        turn["first_token_ms"] = at_ms if turn["first_token_ms"] is None else turn["first_token_ms"]
    elif name in ("policy", "telemetry", "sources"):
        turn[name] = told


def take(held: dict, run_id: str, chunks: Iterator[tuple[int, int, bytes]]) -> None:
    """Adds chunks (seq, at_ms, bytes) to what is held of a run: its turn, the next seq, chunks that wait, and bytes of an open frame."""
    for seq, at_ms, raw in chunks:
        if seq >= held["next"]:
            held["waiting"].setdefault(str(seq), [at_ms, base64.b64encode(raw or b"").decode()])
    while (chunk := held["waiting"].pop(str(held["next"]), None)) is not None:
        held["next"] += 1
        whole, rest = frames(base64.b64decode(held["open"]) + base64.b64decode(chunk[1]))
        held["open"] = base64.b64encode(rest).decode()
        for frame in whole:
            told = event_of(frame)
            if told and held["turn"]["outcome"] == "running":
                held["turn"]["frames"] += 1
                if told[0] in TAKEN or told[0] == "error":
                    receive(held["turn"], run_id, *told, int(chunk[0]))


def _row(run_id: str, turn: dict) -> dict:
    text = lambda v: None if v is None else json.dumps(v, sort_keys=True, ensure_ascii=False)
    step = lambda s: {k: None if s.get(k) is None else str(s[k]) for k in ("id", "phase", "status", "label")}
    usage = turn["usage"] or {}
    return {
        "run_id": run_id,
        **{k: turn[k] for k in ("frames", "outcome", "answer", "first_token_ms", "total_ms", "error")},
        "reported_calls": usage.get("reported_calls"),
        **{k: text(turn[k]) for k in ("usage", "policy", "telemetry", "sources")},
        "steps": [step(s) for s in turn["steps"]],
    }


_COLUMNS = [c.split()[0] for c in "run_id frames outcome answer first_token_ms total_ms reported_calls usage policy telemetry sources steps error".split()]


def turns(chunks: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """A row of TURN for each run and micro-batch that brings it something: its turn so far. latest() keeps the last one.

    With timeout_ms, a run without news for so long fails as broken off, and what comes later starts nothing anew.
    """

    def update(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        warnings.filterwarnings("ignore", category=FutureWarning, message=".*concatenation.*")  # of Spark's own joining of frames with nulls
        held = json.loads(state.get[0]) if state.exists else {"next": 0, "waiting": {}, "open": "", "turn": new_turn()}
        if state.hasTimedOut:
            if held["turn"]["outcome"] == "running":
                failed(held["turn"], BROKEN)
                held["turn"]["frames"] += 1
        else:
            for rows in batches:
                take(held, key[0], zip(rows["seq"].tolist(), rows["at_ms"].tolist(), rows["bytes"].tolist()))
        if held["turn"]["outcome"] != "running":
            held["waiting"], held["open"] = {}, ""  # nothing more is taken
        state.update((json.dumps(held),))
        if timeout_ms and held["turn"]["outcome"] == "running":
            state.setTimeoutDuration(timeout_ms)
        row = _row(key[0], held["turn"])
        yield pd.DataFrame({c: pd.Series([row[c]], dtype="Int64" if c in ("frames", "first_token_ms", "total_ms", "reported_calls") else object) for c in _COLUMNS})

    given = chunks.where(F.col("run_id").isNotNull() & F.col("seq").isNotNull()).select(F.col("run_id").cast("string").alias("run_id"), F.col("seq").cast("long").alias("seq"), F.coalesce(F.col("at_ms").cast("long"), F.lit(0)).alias("at_ms"), F.coalesce("bytes", F.lit(b"")).alias("bytes"))
    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return given.groupBy("run_id").applyInPandasWithState(update, TURN, "held string", "append", kind)


def latest(rows: DataFrame) -> DataFrame:
    """The last state of each run: the one with most frames, and of those one that has ended."""
    order = Window.partitionBy("run_id").orderBy(F.desc("frames"), (F.col("outcome") == "running").cast("int"))
    return rows.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def stopped(rows: DataFrame, cancelled: Column) -> DataFrame:
    """Turns as they are after a stop or a restore: what was running is interrupted (cancelled) or failed, and so are its running steps."""
    running = F.col("outcome") == "running"
    step = lambda s: F.when(s["status"] == "running", s.withField("status", F.lit("interrupted"))).otherwise(s)
    return (
        rows.withColumn("steps", F.when(running, F.transform("steps", step)).otherwise(F.col("steps")))
        .withColumn("total_ms", F.when(running, F.lit(None).cast("long")).otherwise(F.col("total_ms")))
        .withColumn("outcome", F.when(running, F.when(cancelled, "interrupted").otherwise("failed")).otherwise(F.col("outcome")))
    )


def frame(event: str, data: Column) -> Column:
    """The bytes of a frame, from a struct."""
    return F.concat(F.lit(f"event: {event}\ndata: "), F.to_json(data), F.lit("\n\n"))


def cut(streams: DataFrame, size: int) -> DataFrame:
    """(run_id, seq, at_ms, bytes): each run's stream (run_id, text) in chunks of so many bytes, wherever that cuts; at_ms is ten times seq."""
    raw = F.col("text").cast("binary")
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length(raw) - 1, F.lit(0)), F.lit(size))
    each = streams.select("run_id", raw.alias("b"), F.posexplode_outer(starts).alias("seq", "start"))
    return each.select("run_id", F.col("seq").cast("long").alias("seq"), (F.col("seq") * 10).cast("long").alias("at_ms"), F.substring("b", F.col("start") + 1, F.lit(size)).alias("bytes"))

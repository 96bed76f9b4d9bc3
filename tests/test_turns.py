"""Answer streams: any cut, order and repetition of chunks gives the turns of an uncut stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quarrylight.streaming import events, turns


def sse(*told):
    return "".join(f"event: {name}\ndata: {data if isinstance(data, str) else json.dumps(data, ensure_ascii=False)}\n\n" for name, data in told).encode()


STREAM = sse(
    ("status", {"x": 1}),
    ("step", {"run_id": "r", "id": "1", "phase": "plan", "status": "running", "label": "Ü"}),
    ("step", {"run_id": "other", "id": "9", "phase": "plan", "status": "running"}),
    ("usage", {"reported_calls": 2, "total_tokens": 13}),
    ("token", {"text": "héllo 日本"}),
    ("step", {"run_id": "r", "id": "1", "phase": "plan", "status": "completed", "label": "Ü"}),
    ("usage", {"reported_calls": 1, "total_tokens": 5}),
    ("usage", {"run_id": "other", "reported_calls": 9}),
    ("step", {"run_id": "r", "id": "2", "phase": "read", "status": "running"}),
    ("unknown", {"a": 1}),
    ("token", {"text": ""}),
    ("token", {"text": " and more"}),
    ("sources", [{"doc": 1}]),
    ("policy", {"mode": "a"}),
    ("telemetry", {"ms": 4}),
)
DONE = sse(("done", {"ok": True}), ("token", {"text": "never"}))


def run(chunks):
    held = {"next": 0, "waiting": {}, "open": "", "turn": turns.new_turn()}
    for group in chunks:
        turns.take(held, "r", iter(group))
    return held["turn"]


def test_a_whole_stream():
    t = run([[(0, 5, STREAM + b": comment\n\ndata: x\n\nevent: token\n\n" + DONE)]])
    assert t["outcome"] == "completed" and t["answer"] == "héllo 日本 and more" and t["first_token_ms"] == 5 and t["total_ms"] == 5
    assert t["usage"] == {"reported_calls": 2, "total_tokens": 13} and t["sources"] == [{"doc": 1}] and t["policy"] == {"mode": "a"}
    assert [(s["id"], s["status"]) for s in t["steps"]] == [("1", "completed"), ("2", "running")]


def test_a_cut_at_any_byte_changes_nothing():
    whole = STREAM + DONE
    want = run([[(0, 7, whole)]])
    for k in range(len(whole) + 1):
        assert run([[(0, 7, whole[:k])], [(1, 7, whole[k:])]]) == want, k
    rng = random.Random(2)
    for _ in range(100):
        cuts = sorted(rng.choices(range(len(whole) + 1), k=12))
        chunks = [(n, 7, whole[a:b]) for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(whole)]))]
        chunks += rng.sample(chunks, 4)
        rng.shuffle(chunks)
        assert run([chunks[:6], chunks[6:11], chunks[11:]]) == want


@pytest.mark.parametrize(
    ("end", "error"), [(sse(("error", {"message": "no model"})), "no model"), (sse(("done", {"ok": False})), turns.NOT_DONE), (b"event: token\ndata: {broken\n\n", "unreadable data of token")]
)
def test_failures_end_a_turn(end, error):
    t = run([[(0, 1, STREAM + end + DONE)]])
    assert t["outcome"] == "failed" and t["error"] == error and t["total_ms"] is None
    assert [(s["id"], s["status"]) for s in t["steps"]] == [("1", "completed"), ("2", "interrupted")]


def test_data_over_several_lines_is_joined():
    assert turns.event_of(b'event:  x \ndata: {"a":\ndata:   1}\nid: 3') == ("x", '{"a":\n1}')
    assert turns.event_of(b"event: x") is None and turns.event_of(b"data: 1") is None and turns.event_of(b"") is None


def test_micro_batches_restarts_and_order(spark, tmp_path):
    texts = {"r": STREAM + DONE, "s": sse(("token", {"text": "a"}), ("step", {"run_id": "s", "id": "1", "status": "running"})), "t": sse(("error", {"message": "m"}))}
    rows = [(r, n, n, bytearray(raw[k : k + 7])) for r, raw in texts.items() for n, k in enumerate(range(0, len(raw), 7))]
    random.Random(1).shuffle(rows)
    rows += rows[:9] + [(None, 0, 0, bytearray(b"x"))]
    kind = "run_id string, seq long, at_ms long, bytes binary"
    got = {}
    for k in range(3):  # three files in three runs of the stream, going on from one checkpoint
        spark.createDataFrame(rows[k::3], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
        out = events.drain(turns.turns(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        got = {r.run_id: r for r in turns.latest(out).collect()}
    assert {k: (r.outcome, r.answer, r.error) for k, r in got.items()} == {"r": ("completed", "héllo 日本 and more", None), "s": ("running", "a", None), "t": ("failed", "", "m")}
    assert got["r"].reported_calls == 2 and json.loads(got["r"].usage)["total_tokens"] == 13 and got["s"].usage is None
    after = {r.run_id: r for r in turns.stopped(turns.latest(out), F.lit(True)).collect()}
    assert (after["s"].outcome, after["s"].steps[0].status, after["r"].outcome, after["r"].steps[1].status) == ("interrupted", "interrupted", "completed", "running")
    assert turns.stopped(turns.latest(out), F.lit(False)).where("run_id = 's'").first().outcome == "failed"

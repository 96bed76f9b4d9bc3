"""Experiment metrics, contexts, scopes and repeated searches against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from quarrylight.operators import experiments, repeated, scope

HIT = "case_id string, strategy string, retrieval string, alpha double, rank int, chunk_id string, chunk_type string, image_id string, image_path string, page int, text string"


def hits_of(rows):
    return [("c1", "s", "hybrid", 0.7, *r) for r in rows]


ROWS = hits_of(
    [
        (1, "t1", "text", None, None, 3, "plain [Image id=imgcap-4 page=1] and [Image  id=imgcap-5"),
        (2, "k2", "image_caption", "imgcap-2", "a/b.png", None, "a caption"),
        (3, None, "image_caption", None, "", 4, None),
    ]
)
WANT = "[Text evidence #1] id=t1 page=3\nplain [Image id=imgcap-4 page=1] and [Image  id=imgcap-5\n\n[Image evidence #2] id=imgcap-2 page=? path=a/b.png\na caption\n\n[Image evidence #3] id=? page=4\n"


def test_contexts_and_how_they_go_on(spark):
    hits = spark.createDataFrame(ROWS[::-1], HIT)
    whole = experiments.contexts(hits, ["case_id"]).first()
    assert (whole.context, whole.blocks, whole.chars, whole.next_after) == (WANT, 3, len(WANT), None)
    parts, after = [], 0
    while after is not None:
        part = experiments.contexts(hits, ["case_id"], budget=60, after=after).first()
        parts.append(part.context)
        assert part.chars == len(part.context) and (part.chars <= 60 or part.blocks == 1)
        after = part.next_after
    assert "\n\n".join(parts) == WANT and len(parts) >= 2
    assert experiments.contexts(hits, ["case_id"], after=3).count() == 0


def test_metrics_of_a_run(spark):
    hits = spark.createDataFrame(ROWS, HIT)
    runs = spark.createDataFrame([("c1", "s", "hybrid", 0.7), ("c2", "s", "hybrid", 0.7), ("c3", "s", "vector", 1.0)], "case_id string, strategy string, retrieval string, alpha double")
    cases = spark.createDataFrame([("c1", ["t1", "x"], ["imgcap-5", "imgcap-2", "imgcap-9"]), ("c2", ["t1"], []), ("c3", None, None)], "case_id string, gold_chunk_ids array<string>, gold_image_ids array<string>")
    got = {r.case_id: r for r in experiments.run_metrics(runs, hits, cases).collect()}
    one = got["c1"]
    assert (one.image_evidence_count, one.inline_image_mention_count, one.image_reference_count, one.image_evidence_ratio, one.context_chars) == (2, 2, 4, 0.6667, len(WANT))
    assert (one.retrieved_chunk_ids, one.retrieved_image_ids) == (["k2", "t1"], ["imgcap-2", "imgcap-4", "imgcap-5"])
    assert (one.gold_chunk_hit, one.gold_chunk_hit_count, one.gold_image_hit, one.gold_image_hit_count) == (True, 1, True, 2)
    assert (got["c2"].hits, got["c2"].context_chars, got["c2"].gold_chunk_hit, got["c2"].image_evidence_ratio) == (0, len(experiments.NO_EVIDENCE), False, 0.0)
    told = {r.retrieval: r for r in experiments.matrix(experiments.run_metrics(runs, hits, cases)).collect()}
    assert (told["hybrid"].runs, told["hybrid"].gold_image_recall_at_k, told["hybrid"].gold_chunk_recall_at_k, told["hybrid"].avg_image_reference_count) == (2, 1.0, 0.5, 2.0)
    assert told["vector"].gold_image_recall_at_k is None and told["vector"].gold_chunk_recall_at_k is None


def bind_plainly(q, docs):
    reference, allowed, needs, text = q[1:]
    ids = {d[0] for d in docs}
    if allowed is not None and not set(allowed) <= ids:
        return "scope_missing", allowed
    if not needs:
        return None, allowed
    matches = [d[0] for d in docs if reference and reference in d]
    if reference and reference.casefold() not in (text or "").casefold():
        return "scope_ambiguous", allowed
    if reference and not matches:
        return "scope_missing", allowed
    if reference and len(matches) > 1:
        return "scope_ambiguous", allowed
    if not reference and not allowed:
        return "scope_ambiguous", allowed
    if matches and allowed and matches[0] not in allowed:
        return "scope_conflict", allowed
    return None, matches or allowed


def test_scopes_match_a_plain_loop(spark):
    rng = random.Random(7)
    docs = [(f"d{k}", rng.choice(["Title A", "Title B", f"Title {k}", "d1", None, ""]), rng.choice([f"file{k}", "file0", None])) for k in range(12)]
    refs = ["d1", "d3", "Title A", "Title 4", "Title 7", "file0", "file5", "nothing", "", None]
    rows = [(k, rng.choice(refs), rng.choice([None, [], ["d3"], ["d1", "d4"], ["d7", "gone"], ["d5", "d5"]]), rng.choice([True, True, False, None]), rng.choice(["about TITLE a and d1 d3 file5", "title 4, Title 7 file0 nothing", "", None])) for k in range(400)]
    questions = spark.createDataFrame(rows, "question_id int, reference string, allowed_doc_ids array<string>, needs_scope boolean, user_text string")
    bound = scope.bind(questions, spark.createDataFrame(docs, "doc_id string, title string, origin string"))
    got = {r.question_id: (r.stop_reason, r.bound_doc_ids) for r in bound.collect()}
    assert got == {q[0]: bind_plainly(q, docs) for q in rows}
    assert len({v[0] for v in got.values()}) == 4
    plan = bound._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_title_of_most_documents_is_one_row(spark):
    docs = spark.range(5000).select(F.col("id").cast("string").alias("doc_id"), F.lit("same").alias("title"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("origin"))
    got = scope.keys(docs).where("key in ('same', 'o7', '7')").orderBy("key").collect()
    assert [(r.key, r.n, r.doc_id) for r in got] == [("7", 1, "7"), ("o7", 1, "7"), ("same", 5000, "0")]


@pytest.mark.parametrize("budget", [1, 2, 5])
def test_repeated_searches_are_asked_once(spark, budget):
    rows = [("a", 1, "Red  Fox"), ("a", 2, "blue"), ("a", 3, " red fox "), ("a", 4, "green"), ("b", 1, "BLUE"), ("b", 2, None), ("b", 3, "blue")]
    questions = repeated.budgeted(spark.createDataFrame(rows, "run_id string, seq int, text string"), budget)
    want, seen = {}, {}
    for run, seq, text in rows:
        key, known = " ".join((text or "").lower().split()), seen.setdefault(run, [])
        cached = key in known
        if not cached:
            known.append(key)
        refused = known.index(key) >= budget
        want[run, seq] = (key, refused, cached and not refused)
    assert {(r.run_id, r.seq): (r.key, r.refused, r.cached) for r in questions.collect()} == want
    asked = []

    def search(queries):
        asked.extend(r.key for r in queries.collect())
        return queries.where("key <> ''").select("key", F.explode(F.split("text", " ")).alias("word"))

    got = repeated.answered(questions, search).groupBy("run_id", "seq").agg(F.count("word").alias("n")).collect()
    assert sorted(asked) == sorted({k for k, refused, _ in want.values() if not refused})
    assert {(r.run_id, r.seq): r.n for r in got} == {k: len(key.split()) * (not refused) for k, (key, refused, _) in want.items()}

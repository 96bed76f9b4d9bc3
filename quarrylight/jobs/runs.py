"""Queries on run events and conversations, in batch and as streams that read all there is and end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import word_tokens
from quarrylight.jobs.shared import folder
from quarrylight.operators import decisions, evaluation, events, web
from quarrylight.streaming import events as streams
from quarrylight.streaming import turns


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stage_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Events and their total time by run and phase."""
    return events.stage_times(_t(spark, sf, "events"))


def usage_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Each run's calls and counter, null unless all calls have reported it."""
    return events.usage_ledger(_t(spark, sf, "events"))


def event_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """The last phase and value of each run, and how long it took."""
    return events.reduced(_t(spark, sf, "events"))


def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events by hour and phase."""
    return events.windowed(_t(spark, sf, "events"))


def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a run, ended by gaps of half an hour."""
    return events.sessions(_t(spark, sf, "events"))


def stream_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The stateful reducer over the events as a stream: the last state of each run."""
    base = folder(spark, "steps")
    out = streams.drain(streams.step_states(streams.read(spark, f"{sf}/events.parquet"), None), f"{base}/out", f"{base}/state")
    return out.groupBy("user_id").agg(F.max_by("last_phase", "steps").alias("last_phase"), F.max("steps").alias("steps"))


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows over the events as a stream with a watermark; those that the watermark has closed are out."""
    base = folder(spark, "windows")
    timed = streams.read(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = streams.drain(events.windowed(timed), f"{base}/out", f"{base}/state")
    return out.withColumn("begin", F.col("begin").cast("timestamp_ntz"))


def _answer_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as answer streams, in chunks of 512 bytes: a step for each turn, a token and the usage for each turn of an assistant,
    a step of a foreign run, and an end if the last turn is odd (done) or every fourth one (error)."""
    said = _t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("run_id"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    step = turns.frame("step", F.struct("run_id", F.col("turn").cast("string").alias("id"), F.col("role").alias("phase"), F.lit("running").alias("status")))
    foreign = turns.frame("step", F.struct(F.lit("other").alias("run_id"), F.lit("x").alias("id")))
    token = turns.frame("token", F.struct("text"))
    usage = turns.frame("usage", F.struct("run_id", F.col("turn").alias("reported_calls")))
    told = said.withColumn("f", F.when(F.col("role") == "assistant", F.concat(step, foreign, token, usage)).otherwise(F.concat(step, foreign)))
    whole = told.groupBy("run_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "f"))), lambda x: x["f"]), "").alias("text"), F.max("turn").alias("last"))
    end = F.when(F.col("last") % 2 == 1, turns.frame("done", F.struct(F.lit(True).alias("ok")))).when(F.col("last") % 4 == 0, turns.frame("error", F.struct(F.lit("no answer").alias("message")))).otherwise("")
    return turns.cut(whole.select("run_id", F.concat("text", end).alias("text")), 512)


def turn_states(spark: SparkSession, sf: str) -> DataFrame:
    """The last state of each answer: its stream is read in four micro-batches, chunks of a run in any of them."""
    base = folder(spark, "turns")
    chunks = _answer_chunks(spark, sf)
    chunks.repartition(4, F.xxhash64("run_id", "seq")).write.parquet(f"{base}/chunks")
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/chunks")
    out = turns.latest(streams.drain(turns.turns(stream), f"{base}/out", f"{base}/state"))
    interrupted = F.size(F.filter("steps", lambda s: s["status"] == "interrupted")).cast("long")
    return out.select("run_id", "frames", "outcome", F.sha2("answer", 256).alias("answer_sha"), "reported_calls", F.size("steps").cast("long").alias("steps"), interrupted.alias("interrupted"), "error", (F.col("total_ms").isNotNull()).alias("timed"))


def conversation_history(spark: SparkSession, sf: str) -> DataFrame:
    """The last nine rows of each conversation."""
    return evaluation.history(_t(spark, sf, "conversations"))


def observed_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses and mail hosts that users named or documents hold, with their canonical form; what assistants say doesn't count."""
    said = _t(spark, sf, "conversations").where("role = 'user'").select(F.lit("user").alias("origin"), F.col("conv_id").alias("id"), "text")
    read = _t(spark, sf, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    found = said.unionByName(read).select("origin", "id", F.explode(F.regexp_extract_all("text", F.lit(web.URL + "|@[A-Za-z0-9.-]+"), F.lit(0))).alias("url"))
    bare = F.regexp_replace("url", "[.,;，。；]+$", "")
    return found.select("origin", "id", bare.alias("url")).groupBy("origin", "id", "url").agg(F.count("*").alias("times")).withColumn("canonical", web.canonical(F.col("url")))


def execution_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a turn of a user is answered quickly, and whether it is a greeting."""
    turns = _t(spark, sf, "conversations").where("role = 'user'")
    return turns.select("conv_id", "turn", decisions.execution_mode(F.col("text"), F.col("turn") == 0).alias("mode"), decisions.is_social(F.col("text")).alias("social"), F.size(word_tokens(F.col("text"))).cast("long").alias("n_tokens"))


def repair_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a run taken as its assessment: what follows, by the decision table."""
    count = lambda c: F.count_if(c)
    kind = F.col("event_type")
    runs = _t(spark, sf, "events").groupBy("user_id").agg(count(kind == "error").alias("errors"), count(kind == "purchase").alias("supported"), count(kind.isin("purchase", "signup")).alias("items"), count(kind == "view").alias("views"), count(kind == "click").alias("clicks"), F.count_if(F.col("value") > 50).alias("high"))
    decision = decisions.repair_decision(F.col("errors") > 12, F.when(F.col("items") > 0, F.col("items")), F.col("supported"), F.col("high") % 4, F.col("views") % 8, F.col("clicks") % 3, F.col("views") % 2 == 1, F.col("clicks") % 2 == 1, F.col("clicks") % 9)
    return runs.select("user_id", decision.alias("decision"))


QUERIES = {f.__name__: f for f in (stage_telemetry, usage_ledger, event_reduce, event_windows, event_sessions, stream_steps, stream_windows, turn_states, conversation_history, observed_urls, execution_modes, repair_decisions)}

ORACLES = {
    "stage_telemetry": "SELECT user_id, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "usage_ledger": "SELECT user_id, count(*) AS calls, count(k) AS reported, CASE WHEN count(*) = count(k) THEN sum(k)::BIGINT END AS total FROM (SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY user_id",
    "event_reduce": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_phase, arg_max(value, (ts, event_id)) AS last_value, count(DISTINCT event_type) AS phases, trunc(epoch(max(ts)) - epoch(min(ts)))::BIGINT AS seconds FROM events GROUP BY user_id",
    "event_windows": "SELECT time_bucket(INTERVAL 1 hour, ts) AS begin, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "event_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, min(ts) AS begin, count(*) AS n FROM s GROUP BY user_id, s",
    "stream_steps": "SELECT user_id, arg_max(event_type, event_id) AS last_phase, count(*) AS steps FROM events GROUP BY user_id",
    "stream_windows": "WITH w AS (SELECT time_bucket(INTERVAL 1 hour, ts) AS begin, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL) SELECT * FROM w WHERE begin + INTERVAL 1 hour <= (SELECT max(ts) - INTERVAL 10 minutes FROM events)",
    "turn_states": """WITH c AS (SELECT conv_id::VARCHAR AS run_id, max(turn) AS last, count(*) AS n, count(*) FILTER (role = 'assistant') AS a, coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS answer,
max(turn) FILTER (role = 'assistant') AS reported_calls FROM conversations GROUP BY conv_id)
SELECT run_id, 2 * n + 2 * a + (last % 2 = 1 OR last % 4 = 0)::INT AS frames, CASE WHEN last % 2 = 1 THEN 'completed' WHEN last % 4 = 0 THEN 'failed' ELSE 'running' END AS outcome, sha256(answer) AS answer_sha, reported_calls,
n AS steps, CASE WHEN last % 4 = 0 THEN n ELSE 0 END AS interrupted, CASE WHEN last % 4 = 0 THEN 'no answer' END AS error, last % 2 = 1 AS timed FROM c""",
    "conversation_history": "WITH k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role, text) AS n FROM conversations) SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn, role, text) AS roles, sum(length(text))::BIGINT AS chars FROM k WHERE n <= 9 GROUP BY conv_id",
    "observed_urls": r"""WITH t AS (SELECT 'user' AS origin, conv_id AS id, text FROM conversations WHERE role = 'user' UNION ALL SELECT 'document', doc_id, text FROM documents),
u AS (SELECT origin, id, regexp_replace(unnest(regexp_extract_all(text, 'https?://[^\s<>"'')\]]+|@[A-Za-z0-9.-]+')), '[.,;，。；]+$', '') AS url FROM t)
SELECT origin, id, url, CASE WHEN regexp_matches(url, '^https://[^/@\s]+') THEN regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '\.md$', '') END AS canonical, count(*) AS times FROM u GROUP BY ALL""",
    "execution_modes": r"""SELECT conv_id, turn, CASE WHEN turn = 0 AND length(text) < 180 AND NOT regexp_matches(lower(text), '比较|对比|审计|设计|方案|分别|compare|audit|design') THEN 'quick' ELSE 'research' END AS mode,
regexp_matches(text, '(?i)^(?:你好|您好|嗨|谢谢|多谢|再见|hello|hi|thanks)[！!。.?？\s]*$') AS social, len(regexp_extract_all(lower(text), '[a-z0-9_]+|[\x{4e00}-\x{9fff}]+')) AS n_tokens FROM conversations WHERE role = 'user'""",
    "repair_decisions": """WITH r AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS supported, count(*) FILTER (event_type IN ('purchase', 'signup')) AS items,
count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (value > 50) AS high FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN errors > 12 THEN 'corpus_unavailable' WHEN items = 0 THEN 'handoff_missing' WHEN supported = items THEN 'covered' WHEN high % 4 >= 3 THEN 'round_limit'
WHEN high % 4 > 1 AND clicks % 3 = 0 THEN 'no_progress' WHEN views % 8 >= 6 THEN 'read_limit' WHEN views % 2 = 1 OR clicks % 2 = 1 AND clicks % 9 < 6 THEN 'repair'
WHEN clicks % 2 = 1 THEN 'search_limit' ELSE 'partial_or_clarify' END AS decision FROM r""",
}

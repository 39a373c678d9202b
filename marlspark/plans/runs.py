"""Queries: staged runs over events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup as D
from ..operators import runs as R
from ..operators import sequences as Q
from ..streaming import progress as P
from .base import Catalog, table

CATALOG = Catalog()

_MESSAGES = ("HTTP 429 seen", "Permission denied, quota", "all fine", "Request timed out", "ECONNRESET by peer", "rate limit; service unavailable")
_OUTPUT = "CASE conv_id % 6 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MESSAGES)) + " END"
_CASES = lambda patterns, value: " ".join(f"WHEN regexp_matches(lower(o), '{p}') THEN {value(p)}" for p in patterns)


@CATALOG.query(f"SELECT conv_id, turn, CASE {_CASES(X.FATAL, lambda p: f"'{p}'")} {_CASES(X.RETRYABLE, lambda p: f"'{p}'")} ELSE 'exit_code_' || (turn % 3) END AS kind, CASE {_CASES(X.FATAL, lambda p: 'false')} {_CASES(X.RETRYABLE, lambda p: 'true')} ELSE false END AS retryable FROM (SELECT conv_id, turn, {_OUTPUT} AS o FROM conversations)")
def failure_classify(spark, sf_dir):
    output = F.element_at(F.array(*map(F.lit, _MESSAGES)), (F.col("conv_id") % 6 + 1).cast("int"))
    kind, retryable = X.failure_kind(output, F.col("turn") % 3)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("kind"), retryable.alias("retryable"))


_STREAKS = "SELECT user_id, event_id, ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("failed", F.col("event_type") == "error")


@CATALOG.query(f"SELECT user_id, event_id, CAST(streak AS BIGINT) AS streak FROM ({_STREAKS})")
def consecutive_failures(spark, sf_dir):
    return R.consecutive(_events(spark, sf_dir), "user_id", ["ts", "event_id"], "failed").select("user_id", "event_id", "streak")


_ALL = "SELECT event_id, ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)"


@CATALOG.query(f"SELECT event_id, CAST(streak AS BIGINT) AS streak FROM ({_ALL})")
def streak_of_all(spark, sf_dir):
    """Failures in a row over one sequence of all events, as one producer sees them."""
    return Q.streaks(_events(spark, sf_dir), ["ts", "event_id"], "failed").select("event_id", "streak")


@CATALOG.query(f"SELECT user_id, arg_min(event_id, row(ts, event_id)) AS event_id FROM ({_STREAKS}) WHERE streak >= 2 GROUP BY user_id")
def circuit_breaker(spark, sf_dir):
    """Where each user's breaker opens, at two errors in a row."""
    return R.tripped(_events(spark, sf_dir), "user_id", ["ts", "event_id"], "failed", 2).select("user_id", "event_id")


@CATALOG.query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS attempt, CAST(2.0 * row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS DOUBLE) AS backoff_sec FROM conversations")
def attempts_backoff(spark, sf_dir):
    return R.attempts(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", ["turn"])


@CATALOG.query("SELECT doc_id FROM labels WHERE quality = 0 OR toxic = 1")
def retry_failed(spark, sf_dir):
    status = lambda c, bad: F.when(F.col(c) == bad, "failed").otherwise("completed")
    runs = table(spark, sf_dir, "labels").select("doc_id", status("quality", 0).alias("analysis_status"), status("toxic", 1).alias("review_status"))
    return R.retries(runs, "analysis_status", "review_status").select("doc_id")


@CATALOG.query("SELECT analysis, review, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN d.doc_id % 13 = 0 THEN 'reused' WHEN quality = 1 THEN 'completed' ELSE 'failed' END AS analysis, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN quality = 0 AND d.doc_id % 13 <> 0 THEN 'skipped' WHEN toxic = 1 THEN 'failed' ELSE 'completed' END AS review FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY ALL")
def status_lifecycle(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    analysis, review = R.lifecycle(F.col("quality").isNotNull(), F.col("doc_id") % 13 == 0, F.col("quality") == 1, F.col("toxic") != 1)
    return joined.select(analysis.alias("analysis"), review.alias("review")).groupBy("analysis", "review").agg(F.count("*").alias("n"))


@CATALOG.query("SELECT user_id, max_by(event_type, event_id) AS state, max_by(value, event_id) FILTER (event_type <> 'view') AS value FROM events GROUP BY user_id")
def latest_status(spark, sf_dir):
    """The last state of each job; a field that the last record lacks keeps its earlier value."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("state"), F.when(F.col("event_type") != "view", F.col("value")).alias("value"), "event_id")
    return R.latest_status(rows, ["user_id"], ["event_id"]).select("user_id", "state", "value")


@CATALOG.query("SELECT time_bucket(INTERVAL '15 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def heartbeats(spark, sf_dir):
    from ..streaming.stages import heartbeats as beats

    return beats(table(spark, sf_dir, "events"), "15 minutes", ts="ts", key="event_type").select("start", "event_type", "n")


_BEATS = "SELECT user_id AS run, CASE event_type WHEN 'view' THEN 'idle' WHEN 'error' THEN 'failed' ELSE 'progress' END AS state, ts, event_id AS batch, value FROM events WHERE user_id IS NOT NULL"


def _beats(spark, sf_dir):
    state = F.when(F.col("event_type") == "view", "idle").when(F.col("event_type") == "error", "failed").otherwise("progress")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("user_id").alias("job"), state.alias("state"), "ts", F.col("event_id").alias("batch"), F.col("value").cast("long").alias("rows"))


@CATALOG.query(f"SELECT run, arg_max(state, row(ts, batch)) AS state, max(ts) AS last, max(ts) FILTER (state = 'progress') AS worked, count(DISTINCT batch) FILTER (state = 'progress') AS batches, CAST(coalesce(sum(trunc(value)), 0) AS BIGINT) AS rows FROM ({_BEATS}) GROUP BY run")
def stream_states(spark, sf_dir):
    """What each run's beats come to: last state, progress, batches and rows."""
    return P.states(_beats(spark, sf_dir)).drop("job")


@CATALOG.query(f"SELECT run, CASE WHEN last < TIMESTAMP '2024-01-30 12:00:00' THEN 'stalled' ELSE 'idle' END AS sign FROM (SELECT run, arg_max(state, row(ts, batch)) AS state, max(ts) AS last, max(ts) FILTER (state = 'progress') AS worked FROM ({_BEATS}) GROUP BY run) WHERE state <> 'failed' AND (last < TIMESTAMP '2024-01-30 12:00:00' OR coalesce(worked < TIMESTAMP '2024-01-30 12:00:00', state = 'idle'))")
def silent_streams(spark, sf_dir):
    """Runs that have not ended and gave no sign, or idle ones only, in the last twelve hours of January."""
    return P.silent(_beats(spark, sf_dir), "2024-01-31 00:00:00", 12 * 3600).select("run", "sign")


@CATALOG.query("SELECT c.conv_id, c.turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.conv_id AND l.quality = 1)")
def resume_pending(spark, sf_dir):
    """What a resumed run still has to do: all but what its manifest holds as valid."""
    done = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("conv_id"))
    return D.without(table(spark, sf_dir, "conversations").select("conv_id", "turn"), done, "conv_id")

"""Staged processing as Structured Streaming: bounded hand-off, retries, breaker, heartbeats, event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

Stage = Callable[[DataFrame], DataFrame]


def run_stage(spark: SparkSession, source: str, schema: str, stage: Stage, target: str, checkpoint: str, queue: int = 1, serial: Stage | None = None) -> StreamingQuery:
    """One stage from a folder to a folder, at most ``queue`` files a batch, until the source has no more.

    With ``serial`` both stages run for a batch before the next begins; otherwise a
    second query on ``target`` overlaps with this one. The checkpoint makes a rerun
    take only what is new.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(queue, 1)).parquet(source)

    def both(batch: DataFrame, number: int) -> None:
        out = stage(batch)
        if serial is not None:
            out = serial(out)
        # A batch that is run again overwrites what it wrote before.
        out.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def heartbeats(status: DataFrame, every: str = "15 seconds", late: str = "1 minute", ts: str = "ts", key: str = "job") -> DataFrame:
    """Records of each job in tumbling windows: works on streams and tables."""
    return status.withWatermark(ts, late).groupBy(F.window(ts, every), key).agg(F.count("*").alias("n"), F.max(ts).alias("last")).select(F.col("window.start").alias("start"), key, "n", "last")


def breaker_stream(events: DataFrame, key: str = "job", most: int = 3) -> DataFrame:
    """key, ts, streak and open for each event of a stream (key, ts, failed): state is one count for each key."""
    schema = f"{key} string, ts timestamp, streak long, open boolean"

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        streak, open_ = state.get if state.exists else (0, False)
        rows = pd.concat(list(frames)).sort_values("ts")
        out = []
        for ts, failed in zip(rows["ts"], rows["failed"], strict=True):
            streak = streak + 1 if failed else 0
            open_ = bool(open_ or streak >= most)
            out.append((k[0], ts, streak, open_))
        state.update((int(streak), bool(open_)))
        yield pd.DataFrame(out, columns=[key, "ts", "streak", "open"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    return events.groupBy(key).applyInPandasWithState(step, schema, "streak long, open boolean", "append", GroupStateTimeout.NoTimeout)


def run_with_retries(call: Callable[[dict], tuple[int, str]], job: dict, most: int = 2, base: float = 2.0, sleep: Callable[[float], None] | None = None) -> dict:
    """A job's call with linear waits between tries of retryable failures; its status record.

    ``call`` returns an exit code and its output; 124 is a timeout.
    """
    import re
    import time

    from ..functions.text import FATAL, RETRYABLE

    wait = sleep or time.sleep
    for attempt in range(1, most + 2):
        code, output = call(job)
        if code == 0:
            return {**job, "status": "completed", "attempt": attempt, "failure_kind": None}
        low = output.lower()
        fatal = next((p for p in FATAL if re.search(p, low)), None)
        again = None if fatal else next((p for p in RETRYABLE if re.search(p, low)), None)
        if not again or attempt > most:
            return {**job, "status": "failed", "attempt": attempt, "failure_kind": fatal or again or f"exit_code_{code}"}
        wait(base * attempt)
    raise AssertionError


def run_command(command: list[str], seconds: float, grace: float = 10.0) -> tuple[int, str, str]:
    """Exit code, output and errors of a process; after ``seconds`` its group is asked to end, then made to, and the code is 124."""
    import os
    import signal
    import subprocess

    p = subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, errors="replace", start_new_session=True)
    try:
        out, err = p.communicate(timeout=seconds)
        return p.returncode, out, err
    except subprocess.TimeoutExpired:
        os.killpg(p.pid, signal.SIGTERM)
    try:
        out, err = p.communicate(timeout=grace)
    except subprocess.TimeoutExpired:
        os.killpg(p.pid, signal.SIGKILL)
        out, err = p.communicate()
    return 124, out, f"{err}\nprocess timed out after {seconds:g} seconds\n"


def breaking(kind: str | None) -> bool:
    """Whether a failure of this kind counts towards the breaker: what a backend may get over, not what is wrong with the job."""
    from ..functions.text import BREAKING, FATAL

    return kind is not None and kind not in FATAL and any(b in kind for b in BREAKING)


def run_jobs(jobs: list[dict], call: Callable[[dict], tuple[int, str]], most_failures: int = 3, dry_run: bool = False, made: Callable[[dict], bool] | None = None, needs: Callable[[dict], bool] | None = None, **options) -> list[dict]:
    """Status records of jobs in order; the producer stops once ``most_failures`` in a row were of a breaking kind, and the rest stay pending.

    Success and failures of other kinds begin the count anew. A job whose output is ``made`` (there and valid) is reused, one
    whose input ``needs`` finds missing is skipped; one that succeeds and has made nothing valid has failed after all.
    A dry run calls nothing: its records hold the command that would run.
    """
    records, streak = [], 0
    for job in jobs:
        if streak >= most_failures:
            records.append({**job, "status": "pending"})
        elif needs is not None and not needs(job):
            records.append({**job, "status": "skipped"})
        elif made is not None and made(job):
            records.append({**job, "status": "reused"})
        elif dry_run:
            records.append({**job, "status": "dry_run", "preview": " ".join(job.get("command", ()))})
        else:
            done = run_with_retries(call, job, **options)
            if done["status"] == "completed" and made is not None and not made(job):
                done = {**done, "status": "failed", "failure_kind": "no_valid_output"}
            streak = streak + 1 if done["status"] == "failed" and breaking(done["failure_kind"]) else 0
            records.append(done)
    return records


def dry_run(jobs: DataFrame, command: str = "command") -> DataFrame:
    """Records of a run that calls nothing: status and a preview of each command."""
    return jobs.withColumns({"status": F.lit("dry_run"), "preview": F.array_join(command, " ")}).drop(command)


def sliding(events: DataFrame, size: str, slide: str, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, size, slide)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")

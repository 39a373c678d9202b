"""Heartbeats of running streams: what their progress events say, as rows of a table."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "run string, job string, state string, ts timestamp, batch long, rows long, seconds double, error string"


class Beats(StreamingQueryListener):
    """Appends a row to the JSON table ``path`` for each event of a stream: started, progress, idle or terminated.

    ``job`` is the query's name or, without one, its id. Rows are held until there are ``most`` or a stream ends, so that
    memory is bounded and few files are made; ``flush`` writes what is held. An idle stream tells so
    once in ``spark.sql.streaming.noDataProgressEventInterval``. A long batch tells nothing until it ends: see ``silent``.
    """

    def __init__(self, spark: SparkSession, path: str, most: int = 20):
        self.spark, self.path, self.most = spark, path, most
        self.held: list[tuple] = []
        self.names: dict[str, str] = {}
        self.lock = threading.Lock()

    def _beat(self, run: uuid.UUID, state: str, at: str | None, batch: int | None = None, rows: int | None = None, seconds: float | None = None, error: str | None = None, last: bool = False) -> None:
        with self.lock:
            self.held.append((str(run), self.names.get(str(run)), state, at, batch, rows, seconds, error))
            full = len(self.held) >= self.most
        if full or last:
            self.flush()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)
        self._beat(event.runId, "started", event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.names.setdefault(str(p.runId), p.name or str(p.id))
        self._beat(p.runId, "progress", p.timestamp, p.batchId, p.numInputRows, (p.batchDuration or 0) / 1000)

    def onQueryIdle(self, event) -> None:
        self.names.setdefault(str(event.runId), str(event.id))
        self._beat(event.runId, "idle", event.timestamp)

    def onQueryTerminated(self, event) -> None:
        from datetime import datetime, timezone

        error = event.exception.splitlines()[0] if event.exception else None
        self._beat(event.runId, "failed" if error else "terminated", datetime.now(timezone.utc).isoformat(), error=error, last=True)
        self.names.pop(str(event.runId), None)

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            text = SCHEMA.replace("ts timestamp", "ts string")
            df = self.spark.createDataFrame(rows, text).withColumn("ts", F.to_timestamp("ts"))
            df.coalesce(1).write.mode("append").json(self.path)


def beats(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``Beats`` writes; ``streaming.stages.heartbeats`` counts it by windows."""
    return spark.read.schema(SCHEMA).json(path)


def states(rows: DataFrame) -> DataFrame:
    """One row for each run: its last state and when, batches and rows so far, and when it last made progress.

    ``rows`` has the columns of ``SCHEMA``. Events of equal time count in the order of batch, then state. Rows without run go.
    """
    place = F.struct("ts", F.coalesce("batch", F.lit(-1)), "state")
    worked = F.max(F.when(F.col("state") == "progress", F.col("ts"))).alias("worked")
    return rows.where("run IS NOT NULL").groupBy("run").agg(
        F.max_by("job", F.when(F.col("job").isNotNull(), place)).alias("job"), F.max_by("state", place).alias("state"), F.max("ts").alias("last"), worked,
        F.count_distinct(F.when(F.col("state") == "progress", F.col("batch"))).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )


def silent(rows: DataFrame, at: str, seconds: float) -> DataFrame:
    """Runs that have not ended and gave no sign, or none but idle ones, in the ``seconds`` before ``at``: ``stalled`` or ``idle``."""
    since = F.lit(at).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds))
    kind = F.when(F.col("last") < since, "stalled").when(F.coalesce(F.col("worked") < since, F.col("state") == "idle"), "idle")
    live = states(rows).where(~F.col("state").isin("terminated", "failed"))
    return live.withColumn("sign", kind).where("sign IS NOT NULL").select("run", "job", "sign", "last", "worked")

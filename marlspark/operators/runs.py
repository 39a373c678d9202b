"""Staged runs as tables: failures, retries, breaker, status, what is left to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consecutive(events: DataFrame, key: str, order: Sequence[str], failed: str) -> DataFrame:
    """Events with ``streak``: failures in a row so far, 0 after a success."""
    w = Window.partitionBy(key).orderBy(*order)
    runs = events.withColumn("__g", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inner = Window.partitionBy(key, "__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return runs.withColumn("streak", F.sum(F.when(F.col(failed), 1).otherwise(0)).over(inner).cast("long")).drop("__g")


def tripped(events: DataFrame, key: str, order: Sequence[str], failed: str, most: int = 3) -> DataFrame:
    """Where each key's breaker opens: its first event that makes ``most`` failures in a row."""
    hit = consecutive(events, key, order, failed).where(F.col("streak") >= most)
    return hit.groupBy(key).agg(F.min(F.struct(*order)).alias("at")).select(key, "at.*")


def attempts(events: DataFrame, key: str, order: Sequence[str], base: float = 2.0) -> DataFrame:
    """Number of each attempt and the linear wait before the next."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("attempt", n.cast("long")).withColumn("backoff_sec", F.col("attempt") * F.lit(base))


def retries(runs: DataFrame, *status: str) -> DataFrame:
    """Runs in which any stage failed."""
    cond = F.lit(False)
    for s in status:
        cond = cond | (F.col(s) == "failed")
    return runs.where(cond)


def lifecycle(ran: Column, reuse: Column, ok: Column, review_ok: Column) -> tuple[Column, Column]:
    """A job's two states: pending where it has not run; reused, completed or failed; and skipped where the first has failed."""
    analysis = F.when(~ran, "pending").when(reuse, "reused").when(ok, "completed").otherwise("failed")
    review = F.when(~ran, "pending").when(analysis == "failed", "skipped").when(review_ok, "completed").otherwise("failed")
    return analysis, review


def latest_status(events: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record of each job and stage; earlier fields that it lacks are kept."""
    place = F.struct(*order)
    rest = [c for c in events.columns if c not in key]
    return events.groupBy(*key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in rest])


def rollup_status(issues: DataFrame, key: Sequence[str], severity: str = "severity") -> DataFrame:
    """fail where any issue is critical, mixed where there is any, else pass; and counts by severity."""
    n = {s: F.count_if(F.col(severity) == s) for s in ("critical", "major", "minor")}
    total = F.count(severity)
    status = F.when(n["critical"] > 0, "fail").when(total > 0, "mixed").otherwise("pass")
    return issues.groupBy(*key).agg(status.alias("status"), total.alias("issue_count"), *[v.alias(f"{s}_count") for s, v in n.items()])

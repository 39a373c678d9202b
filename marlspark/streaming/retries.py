"""Retries of a stream of jobs, with timers in place of sleeping, and a breaker for each line of jobs.

A line is what shares a backend. Its state holds the jobs that are open (their attempt, and
when the next one is due) and its breaker (failures in a row, open or not); jobs that are
done leave it, so it grows with the open jobs alone. What comes in are submissions
and results of attempts; what goes out are states, of which ``pending`` asks for an attempt:

    submission -> pending 1; after the breaker has opened: skipped
    result 0   -> completed
    a failure that another try may mend, up to ``most`` retries -> waiting, and pending n + 1 after ``base`` * n seconds, by timer
    any other failure, or no retry left -> failed; ``breaking`` ones in a row open the breaker, and what waits is skipped when due

Cases: results of jobs or attempts that are not open are passed over, as are submissions of open jobs, so that
events may be given twice; null outputs are empty; events of a batch count in order of ``ts``.
The session needs the RocksDB state store.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import FATAL, RETRYABLE
from .stages import breaking

EVENT = "line string, job string, attempt int, code int, output string, ts timestamp"
STATE = "line string, job string, status string, attempt int, kind string, due_ms long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def failure(code: int, output: str | None) -> tuple[str, bool]:
    """What a failure is by its output, and whether another try may mend it."""
    low = (output or "").lower()
    fatal = next((p for p in FATAL if re.search(p, low)), None)
    again = None if fatal else next((p for p in RETRYABLE if re.search(p, low)), None)
    return fatal or again or f"exit_code_{code}", again is not None


class Retries(StatefulProcessor):
    def __init__(self, most: int, base: float, most_failures: int):
        self.most, self.base, self.most_failures = most, base, most_failures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "job string", "attempt int, due long")  # due 0: an attempt is under way
        self.breaker = handle.getValueState("breaker", "streak int, open boolean")

    def _breaker(self) -> tuple[int, bool]:
        return tuple(self.breaker.get()) if self.breaker.exists() else (0, False)

    def _states(self, key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            frame = pd.DataFrame([(key[0], *r) for r in rows], columns=["line", "job", "status", "attempt", "kind", "due_ms"])
            yield frame.astype({"attempt": "int32", "due_ms": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        events = pd.concat(list(rows)).sort_values("ts", kind="stable")
        out = []
        for e in events.itertuples(index=False):
            job, known = (e.job,), self.open.containsKey((e.job,))
            streak, stopped = self._breaker()
            if pd.isna(e.code):
                if not known and stopped:
                    out.append((e.job, "skipped", 0, None, 0))
                elif not known:
                    self.open.updateValue(job, (1, 0))
                    out.append((e.job, "pending", 1, None, 0))
                continue
            attempt, due = self.open.getValue(job) if known else (0, 0)
            if not known or due or int(e.attempt) != attempt:
                continue
            kind, again = failure(int(e.code), e.output) if e.code else (None, False)
            if again and attempt <= self.most:
                due = now + int(1000 * self.base * attempt)
                self.open.updateValue(job, (attempt, due))
                self.handle.registerTimer(due)
                out.append((e.job, "waiting", attempt, kind, due))
                continue
            self.open.removeKey(job)
            out.append((e.job, "failed" if e.code else "completed", attempt, kind, 0))
            streak = streak + 1 if breaking(kind) else 0
            self.breaker.update((streak, bool(stopped or streak >= self.most_failures)))
        yield from self._states(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, out = expiredTimerInfo.getExpiryTimeInMs(), []
        stopped = self._breaker()[1]
        for (job,), (attempt, due) in list(self.open.iterator()):
            if due and due <= at:
                if stopped:
                    self.open.removeKey((job,))
                else:
                    self.open.updateValue((job,), (attempt + 1, 0))
                out.append((job, "skipped", attempt, None, 0) if stopped else (job, "pending", attempt + 1, None, 0))
        yield from self._states(key, out)

    def close(self) -> None:
        pass


def retried(events: DataFrame, most: int = 2, base: float = 2.0, most_failures: int = 3) -> DataFrame:
    """The states (``STATE``) that a stream of ``EVENT`` rows leads to; a submission has a null code."""
    return events.groupBy("line").transformWithStateInPandas(Retries(most, base, most_failures), STATE, "Append", "ProcessingTime")

"""A stream of jobs with retries by timer, against the states that each must pass through."""

import time

import pytest

from marlspark.streaming import retries


def test_kinds():
    assert retries.failure(1, "HTTP 429") == (r"\b429\b", True)
    assert retries.failure(1, "permission denied, 429") == ("permission denied", False)
    assert retries.failure(7, None) == ("exit_code_7", False)


def test_waits_retries_and_breaker(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", retries.PROVIDER)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    src, number = tmp_path / "events", [0]

    def send(*rows):
        number[0] += 1
        at = [(line, job, attempt, code, out, 1000.0 * number[0] + i) for i, (line, job, attempt, code, out) in enumerate(rows)]
        df = spark.createDataFrame(at, "line string, job string, attempt int, code int, output string, s double").selectExpr("line", "job", "attempt", "code", "output", "timestamp_seconds(s) AS ts")
        df.coalesce(1).write.mode("append").parquet(str(src))

    send(*[("a", f"j{i}", None, None, None) for i in range(4)], ("b", "k", None, None, None))
    stream = session.readStream.schema(retries.EVENT).parquet(str(src))
    q = retries.retried(stream, most=2, base=1.5).writeStream.format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "c")).start()

    def wait(line, job, status, attempt, seconds=90):
        end = time.time() + seconds
        while time.time() < end:
            if q.exception():
                raise q.exception()
            found = session.table("states").where(f"line = '{line}' AND job = '{job}' AND status = '{status}' AND attempt = {attempt}").collect()
            if found:
                return found[0], time.time()
            time.sleep(0.2)
        pytest.fail(f"{line} {job} {status} {attempt} did not come: {session.table('states').collect()}")

    try:
        for i in range(4):
            wait("a", f"j{i}", "pending", 1)
        send(("a", "j0", 1, 0, ""), ("a", "j0", 1, 1, "429"), ("a", "j1", 1, 1, "unauthorized 429"), ("a", "j2", 1, 1, "timed out"), ("a", "j2", 1, 1, "timed out"), ("b", "k", 1, 1, "429"), ("a", "none", 1, 0, ""))
        wait("a", "j0", "completed", 1)
        assert wait("a", "j1", "failed", 1)[0].kind == "unauthorized"
        first, _ = wait("a", "j2", "waiting", 1)
        _, again = wait("a", "j2", "pending", 2)
        assert again * 1000 >= first.due_ms
        wait("b", "k", "pending", 2)
        send(("a", "j2", 1, 0, ""), ("a", "j2", 2, 1, "timed out"), ("b", "k", 2, 0, "late but well"))
        second, _ = wait("a", "j2", "waiting", 2)
        wait("a", "j2", "pending", 3)
        # The last retry fails, then two more jobs: three breaking failures in a row.
        send(*[("a", f"m{i}", None, None, None) for i in range(3)])
        wait("a", "m2", "pending", 1)
        send(*[("a", "m0", 1, 1, "429")])
        wait("a", "m0", "waiting", 1)
        wait("a", "m0", "pending", 2)
        send(("a", "m0", 2, 1, "503 service unavailable"))
        wait("a", "m0", "waiting", 2)
        wait("a", "m0", "pending", 3)
        send(("a", "j2", 3, 1, "quota"), ("a", "m0", 3, 1, "quota"), ("a", "m1", 1, 1, "429"))
        wait("a", "m1", "waiting", 1)
        wait("a", "m1", "pending", 2)
        send(("a", "m1", 2, 1, "429"))
        wait("a", "m1", "pending", 3)
        send(("a", "m2", 1, 1, "429"), ("a", "m1", 3, 1, "429"))
        wait("a", "m2", "skipped", 1)  # it was waiting when the breaker opened
        send(("a", "late", None, None, None), ("b", "fine", None, None, None))
        wait("a", "late", "skipped", 0)
        wait("b", "fine", "pending", 1)  # another line's breaker
    finally:
        q.stop()
    rows = session.table("states").collect()
    assert len({(r.line, r.job, r.status, r.attempt) for r in rows}) == len(rows)  # nothing twice
    assert {r.status for r in rows} == {"pending", "waiting", "completed", "failed", "skipped"}
    assert {(r.job, r.status) for r in rows if r.job in ("j0", "k", "none")} == {("j0", "pending"), ("j0", "completed"), ("k", "pending"), ("k", "waiting"), ("k", "completed")}

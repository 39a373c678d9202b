"""Streams against their batch forms."""

from pyspark.sql import functions as F

from marlspark.operators import runs
from marlspark.streaming import stages


def test_two_stages_until_the_source_is_empty(spark, tmp_path):
    src, mid = str(tmp_path / "src"), str(tmp_path / "mid")
    for i in range(3):
        spark.range(i * 10, i * 10 + 5).coalesce(1).write.mode("append").parquet(src)
    q = stages.run_stage(spark, src, "id long", lambda d: d.withColumn("a", F.col("id") + 1), mid, str(tmp_path / "c"), serial=lambda d: d.withColumn("b", F.col("a") * 2))
    q.awaitTermination(120)
    assert spark.read.parquet(mid).where("b = (id + 1) * 2").count() == 15
    spark.range(100, 102).coalesce(1).write.mode("append").parquet(src)
    q = stages.run_stage(spark, src, "id long", lambda d: d.withColumn("a", F.col("id") + 1), mid, str(tmp_path / "c"), serial=lambda d: d.withColumn("b", F.col("a") * 2))
    q.awaitTermination(120)
    assert spark.read.parquet(mid).count() == 17


def test_breaker_stream_equals_batch(spark, tmp_path):
    rows = [("a", f"2024-01-01 00:00:0{i}", f) for i, f in enumerate([True, True, False, True, True, True])]
    df = spark.createDataFrame(rows, "job string, t string, failed boolean").select("job", F.to_timestamp("t").alias("ts"), "failed")
    df.coalesce(1).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "s"))
    q = stages.breaker_stream(stream).writeStream.format("memory").queryName("breaker").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    got = [(r.ts, r.streak) for r in spark.table("breaker").orderBy("ts").collect()]
    want = [(r.ts, r.streak) for r in runs.consecutive(df, "job", ["ts"], "failed").orderBy("ts").collect()]
    assert got == want and spark.table("breaker").where("open").count() == 1


def test_retries_wait_linearly():
    codes, waits = iter([(1, "429"), (1, "timed out"), (0, "")]), []
    assert stages.run_with_retries(lambda j: next(codes), {"job": 1}, sleep=waits.append)["attempt"] == 3 and waits == [2.0, 4.0]
    assert stages.run_with_retries(lambda j: (1, "unauthorized 429"), {}, sleep=waits.append)["failure_kind"] == "unauthorized"


def test_commands_time_out_and_producers_stop():
    from marlspark.streaming import stages

    assert stages.run_command(["sh", "-c", "echo a; exit 3"], 20) == (3, "a\n", "")
    code, out, err = stages.run_command(["sh", "-c", "echo b; sleep 60"], 0.5, grace=1)
    assert code == 124 and out == "b\n" and "timed out" in err
    calls = []

    def call(job):
        calls.append(job["n"])
        return (1, answer)

    answer = "permission denied"
    got = stages.run_jobs([{"n": i} for i in range(6)], call, most_failures=3)
    assert [r["status"] for r in got] == ["failed"] * 6 and calls == list(range(6))  # the jobs' own faults open no breaker
    calls.clear()
    answer = "429 slow down"
    got = stages.run_jobs([{"n": i} for i in range(6)], call, most_failures=3, most=0)
    assert [r["status"] for r in got] == ["failed"] * 3 + ["pending"] * 3 and calls == [0, 1, 2]
    calls.clear()
    made = lambda j: j["n"] == 1
    got = stages.run_jobs([{"n": i} for i in range(4)], lambda j: (0, ""), made=made, needs=lambda j: j["n"] != 2)
    assert [(r["status"], r.get("failure_kind")) for r in got] == [("failed", "no_valid_output"), ("reused", None), ("skipped", None), ("failed", "no_valid_output")]
    dry = stages.run_jobs([{"n": 0, "command": ["a", "b"]}], call, dry_run=True)
    assert dry[0]["preview"] == "a b" and not calls


def test_rate_limits_and_waits():
    from marlspark.sources import services as S

    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limit = S.RateLimit(0.5, clock=lambda: now[0], sleep=sleep)
    answers = iter([(429, "", 7.0), (503, "", None), (200, '{"a": 1}', None)])
    assert S.fetch_json(lambda: next(answers), limit, sleep=sleep) == {"a": 1}
    assert slept == [7.0, 4.0]
    limit.wait()
    assert slept[-1] == 2.0
    assert S.fetch_json(lambda: (404, "", None), limit, sleep=sleep) is None
    assert S.lookup_wait(418, 0) is None and S.lookup_wait(429, 9) == 60 and S.page_wait(500, 0) is None and S.page_wait(429, 2) == 6

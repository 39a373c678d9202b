"""Progress events of streams as rows."""

import time

from pyspark.sql import functions as F

from marlspark.streaming import progress


def _until(ready, seconds=60):
    end = time.monotonic() + seconds
    while not ready() and time.monotonic() < end:
        time.sleep(0.3)
    assert ready()


def test_a_stalled_stage_still_beats(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "beats")
    spark.range(7).coalesce(1).write.parquet(src)
    before = spark.conf.get("spark.sql.streaming.noDataProgressEventInterval")
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "300")
    listener = progress.Beats(spark, table, most=1000)
    spark.streams.addListener(listener)
    try:
        q = spark.readStream.schema("id long").parquet(src).writeStream.queryName("stage_one").format("noop")
        q = q.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()
        run = str(q.runId)
        _until(lambda: sum(r[0] == run and r[2] == "idle" for r in listener.held) >= 2)  # no more files: idle events
        listener.flush()
        q.stop()
        _until(lambda: (tmp_path / "beats").exists() and progress.beats(spark, table).where((F.col("run") == run) & (F.col("state") == "terminated")).count() == 1)
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", before)
    rows = progress.beats(spark, table).where(F.col("run") == run)
    found = {r.state: r.n for r in rows.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert found["started"] == 1 and found["progress"] >= 1 and found["idle"] >= 2 and found["terminated"] == 1
    assert rows.where("ts IS NULL OR job <> 'stage_one'").count() == 0
    last = progress.states(rows).first()
    assert (last.job, last.state, last.rows) == ("stage_one", "terminated", 7)


def test_failed_streams_tell_why(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "beats")
    spark.range(3).coalesce(1).write.parquet(src)
    listener = progress.Beats(spark, table)
    spark.streams.addListener(listener)
    try:
        q = spark.readStream.schema("id long").parquet(src).select(F.raise_error(F.lit("broken page"))).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start()
        q.exception() or q.awaitTermination(60)
    except Exception:  # noqa: BLE001 - the failure is the case
        pass
    try:
        _until(lambda: (tmp_path / "beats").exists() and progress.beats(spark, table).where("state = 'failed' AND error IS NOT NULL").count() == 1)
    finally:
        spark.streams.removeListener(listener)


def test_who_is_silent(spark):
    rows = [
        ("a", "a", "progress", "2024-01-01 00:00:00", 0), ("a", "a", "idle", "2024-01-01 00:01:00", None),
        ("b", "b", "progress", "2024-01-01 00:00:00", 0),
        ("c", "c", "terminated", "2024-01-01 00:00:00", None),
        ("d", "d", "progress", "2024-01-01 00:00:50", 3),
        (None, None, "progress", "2024-01-01 00:00:50", 3),
    ]
    df = spark.createDataFrame(rows, "run string, job string, state string, ts string, batch long").withColumn("ts", F.to_timestamp("ts")).withColumn("rows", F.lit(1).cast("long"))
    got = {(r.run, r.sign) for r in progress.silent(df, "2024-01-01 00:01:10", 30).collect()}
    assert got == {("a", "idle"), ("b", "stalled")}
    assert progress.silent(df.limit(0), "2024-01-01 00:01:10", 30).count() == 0

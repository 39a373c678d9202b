"""The lookup format: batches, filters, rates, restarts."""

import glob
import json
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from marlspark.sources.lookups import Group, Ids, lookup_format


def ids(folder, name, values, rows=4):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"other": [0] * len(values), "id": pa.array(values, pa.int64())}), folder / name, row_group_size=rows)


def calls(log):
    return [json.loads(line) for f in glob.glob(f"{log}/*") for line in open(f)]


def asker(log):
    import os

    os.makedirs(log, exist_ok=True)

    def get(asked):
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(json.dumps(asked))
        return [None if i % 5 == 0 else {"n": i * 10, "tags": ["t", None]} for i in asked]

    return get


SCHEMA = "n long, id long, tags array<string>, absent string"


def test_every_listed_id_is_answered_in_bounded_calls(spark, tmp_path):
    ids(tmp_path / "ids", "a.parquet", [1, 2, 2, None, 3, 4, 5, 6, 7], rows=8)
    ids(tmp_path / "ids", "b.parquet", [9, 10])
    ids(tmp_path / "ids", "_temporary.parquet", [99])
    ids(tmp_path / "ids", "empty.parquet", [])
    log = str(tmp_path / "log")
    spark.dataSource.register(lookup_format("numbers", asker(log), SCHEMA, size=3))
    df = spark.read.format("numbers").option("path", str(tmp_path / "ids")).load()
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(i * 10, i, ["t", None], None) for i in (1, 2, 2, 3, 4, 6, 7, 9)]
    asked = calls(log)
    assert sorted(map(sorted, asked)) == [[1, 2], [3, 4, 5], [6], [7], [9, 10]] and df.rdd.getNumPartitions() == 3
    ids(tmp_path / "none", "empty.parquet", [])
    assert spark.read.format("numbers").option("path", str(tmp_path / "none")).load().count() == 0


def test_filters_choose_what_is_asked(spark, tmp_path):
    ids(tmp_path / "ids", "a.parquet", list(range(1, 41)))
    log = str(tmp_path / "log")
    spark.dataSource.register(lookup_format("numbers", asker(log), SCHEMA))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = spark.read.format("numbers").option("path", f"file://{tmp_path}/ids").option("filters", True).load().where("id in (3, 17, 100) and n > 30")
        assert [r["id"] for r in df.collect()] == [17] and sorted(calls(log)) == [[3], [17]]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_rate_is_shared_by_partitions(tmp_path):
    ids(tmp_path / "ids", "a.parquet", list(range(40)))
    path = str(tmp_path / "ids")
    groups = lambda **o: Ids({"path": path, **o}).groups(Ids({"path": path}).files())
    assert [g.rate for g in groups(rate="20")] == [2.0] * 10 and [g.rate for g in groups(rate="20", slots="4")] == [5.0] * 10
    assert groups()[0] == Group(f"{path}/a.parquet", 0, 0.0)
    with pytest.raises(ValueError, match="no column key"):
        groups_of = Ids({"path": path, "column": "key"})
        groups_of.groups(groups_of.files())


def test_a_restarted_stream_asks_for_new_files_alone(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    spark.dataSource.register(lookup_format("numbers", asker(log), SCHEMA))

    def run():
        s = spark.readStream.format("numbers").option("path", str(tmp_path / "ids")).load()
        q = s.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start(out)
        assert q.awaitTermination(60)

    ids(tmp_path / "ids", "f1.parquet", [1, 2, 3])
    run()
    ids(tmp_path / "ids", "f2.parquet", [3, 4])
    run()
    run()
    assert sorted(calls(log)) == [[1, 2, 3], [3, 4]]
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 3, 4]

"""Ordinals and streaks over many partitions against one sorted list; CSV files by their headers."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from marlspark.operators import runs, sequences
from marlspark.schemas import DB, strings
from marlspark.sources import tables


@pytest.fixture
def parts(spark):
    """Many partitions, so that sequences lie across their edges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def _rows(n, seed=3):
    rng = random.Random(seed)
    rows = [("a" if rng.random() < 0.6 else rng.choice(["b", "c", None, "d"]), i, rng.random() < 0.9) for i in range(n)]
    return rows


def test_places_and_neighbours_across_partitions(parts):
    rows = _rows(900)
    df = parts.createDataFrame(rows, "g string, k long, f boolean").repartition(6)
    for group in ([], ["g"]):
        got = {r.k: (r.place, r.previous, r.next) for r in sequences.numbered(df, ["k"], group, "k").collect()}
        want = {}
        for g in {r[0] for r in rows} if group else {0}:
            ks = sorted(k for x, k, _ in rows if not group or x == g)
            want |= {k: (i + 1, ks[i - 1] if i else None, ks[i + 1] if i + 1 < len(ks) else None) for i, k in enumerate(ks)}
        assert got == want
    pages = sequences.paged(df, ["k"], size=7).groupBy("page").count().collect()
    assert {r.page: r["count"] for r in pages} == {i: min(7, 900 - 7 * i) for i in range(129)}
    assert sequences.numbered(df.limit(0), ["k"], [], "k").count() == 0


def test_no_window_holds_a_whole_sequence(parts):
    """Windows over rows are by partition; those without it see one row for each segment."""
    df = parts.createDataFrame(_rows(900), "g string, k long, f boolean")
    plan = sequences.numbered(df, ["k"], ["g"], "k")._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [" in line and "__at" in line]
    assert over_rows and all("__part" in line.split("], [")[1] for line in over_rows)
    dealt = sequences.dealt(df, [], ["k"]).groupBy("__part").count().collect()
    assert len(dealt) > 10 and max(r["count"] for r in dealt) < 200


@pytest.mark.parametrize("bad", [0.0, 0.5, 0.97, 1.0])
def test_streaks_equal_one_pass(parts, bad):
    rng = random.Random(int(bad * 10))
    rows = [(rng.choice(["x", "x", "y", None]), i, None if rng.random() < 0.01 and bad < 1 else rng.random() < bad) for i in range(800)]
    df = parts.createDataFrame(rows, "g string, k long, f boolean").repartition(5)
    for group in ([], ["g"]):
        run, want = {}, {}
        for g, k, f in rows:
            at = g if group else 0
            run[at] = run.get(at, 0) + 1 if f else 0
            want[k] = run[at]
        assert {r.k: r.streak for r in sequences.streaks(df, ["k"], "f", group).collect()} == want
    one = df.withColumns({"all": F.lit(1), "f": F.coalesce("f", F.lit(False))})
    by_window = {r.k: r.streak for r in runs.consecutive(one, "all", ["k"], "f").collect()}
    assert by_window == {r.k: r.streak for r in sequences.streaks(one, ["k"], "f").collect()}


def test_csv_goes_by_names(spark, tmp_path):
    files = {
        "a.csv": '"title","paper_id"\n"T","p1"\n"two\nlines, ""q""","p2"\n',
        "b.csv": 'paper_id,extra,year,year\np3,x,1999,2024\np4\n\np5,x,1999,2025,more,fields\n',
        "c.csv": "",
        "d.csv": "﻿paper_id,venue\np6,V\n",
        "e.csv": '"paper_id","a ""quoted""\nname","title"\np7,x,T7\n',
        "f.csv": "paper_id,title\n",
        ".hidden.csv": "paper_id\nno\n",
        "other.txt": "paper_id\nno\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    want = []
    for name in sorted(n for n in files if n.endswith(".csv") and n[0] != "."):
        with open(tmp_path / name, encoding="utf-8-sig", newline="") as f:
            want += [(r["paper_id"], r.get("title", ""), r.get("year", ""), r.get("venue", "")) for r in csv.DictReader(f)]
    got = tables.read_csv_folder(spark, str(tmp_path), DB).orderBy("_file", "_row")
    assert [tuple(r) for r in got.select("paper_id", "title", "year", "venue").collect()] == want
    assert tables.csv_header(spark, str(tmp_path / "e.csv")) == ("paper_id", 'a "quoted"\nname', "title")
    assert tables.read_csv(spark, [str(tmp_path / "c.csv")], DB).count() == 0
    assert tables.read_csv(spark, str(tmp_path / "[ab].csv"), strings("year paper_id")).columns == ["year", "paper_id", "_file", "_row"]


def test_counts_in_passing_equal_separate_counts(spark):
    from marlspark.operators.counting import Counts

    counts = Counts()
    df = counts.at(spark.range(1000, numPartitions=7), "all", least=F.min("id"))
    odd = counts.at(df.where("id % 2 = 1").repartition(3), "odd", total=F.sum("id"))
    none = counts.at(odd.where("id < 0"), "none")
    assert counts.run(none) == [{"stage": "all", "n": 1000, "least": 0}, {"stage": "odd", "n": 500, "total": sum(range(1, 1000, 2))}, {"stage": "none", "n": 0}]
    assert [tuple(r) for r in counts.table(spark).collect()] == [("all", 1000), ("odd", 500), ("none", 0)]

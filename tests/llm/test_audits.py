"""Exact top-k, filter audit and dominance counts: brute force over the cases that each docstring defines."""

import calendar
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlspark.llm import audit, dominance, exact

VEC = "vec_id long, embedding array<{}>"

# 11


def brute_search(rows, k=10):
    """Every query against every row by Python's integers; ids that repeat count once, with their highest score."""
    kept = [(i, [math.floor(1024 * x) if abs(x) < 2.0**53 else int(x) * 1024 for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = {}
    for i, v in kept:
        for j, w in kept:
            if i % 100 == 0 and i != j:
                score = max(min(sum(a * b for a, b in zip(v, w, strict=False)), 2**63 - 1), -(2**63))
                best[i, j] = max(score, best.get((i, j), score))
    out = []
    for i in {q for q, _ in best}:
        ranked = sorted(((-s, j) for (q, j), s in best.items() if q == i))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(ranked)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_search_equals_brute_force_in_small_blocks(spark, kind):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 0.3), 0.5]) for _ in range(rng.choice([6, 6, 6, 3, 0]))]) for i in range(0, 2000, 5)]
    if kind == "float":
        rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    df = spark.createDataFrame(rows, VEC.format(kind))
    got = exact.search(df, F.col("vec_id") % 100 == 0, candidates=300, queries=40)
    assert found(got) == brute_search(rows)


def test_search_cases(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0, 0.5]), (100, [0.0, 0.0]), (200, []), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (None, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [1.0, 1.0]), (6, [9.0, 9.0]), (7, [1.0]), (8, [1e300, -1e300]), (300, [1e300, 1.0]), (9, [2.0**40, 3.0]), (400, [2.0**40, 2.0**40]),
    ]
    df = spark.createDataFrame(rows, VEC.format("double")).withColumns({c: F.lit("clash") for c in ("score", "rank", "q", "pair", "query_id")})
    assert found(exact.search(df, F.col("vec_id") % 100 == 0)) == brute_search(rows)
    assert exact.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert exact.search(df.where("vec_id = 5"), F.col("vec_id") % 100 == 0).count() == 0
    few = exact.search(df.where("vec_id IN (0, 5)"), F.col("vec_id") % 100 == 0)
    assert [tuple(r) for r in few.collect()] == [(0, 1, 5, 3 * 1024 * 1024)]


def test_search_of_a_row_that_repeats(spark):
    df = spark.range(3000).select((F.col("id") % 2 * 0).alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding")).unionByName(spark.range(1, 60).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding")))
    got = exact.search(df, F.col("vec_id") % 100 == 0, candidates=500)
    assert [r.vec_id for r in got.orderBy("rank").collect()] == list(range(59, 49, -1))


# 12


def brute_audit(docs, labels):
    """Each order's filters one after the other over plain rows."""
    space = " \t\n\v\f\r"
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    least, rows, out = {}, [], {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    for d, text, lang in docs:
        t = text or ""
        words = "".join(" " if c in space else c for c in t).split(" ")
        words = [w for w in words if w]
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        fails |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        fails |= {"E"} if d is not None and least[t] < d else set()
        rows.append((lang or "", fails, d in good, d in toxic))
    for part in {r[0] for r in rows}:
        removed = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                all_fail = [r for r in rows if r[0] == part and f in r[1]]
                removed[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(all_fail) - len(gone), sum(r[1] == {f} for r in all_fail), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for key, v in out.items():
            if key[0] == part:
                v.append(removed[key[1][key[2] - 1]])
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(2)
    many = lambda n, v: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    texts = [many(300, 900), many(300, 20), many(250, 3) + " # ", many(10, 9), "ALL CAPS HERE " * 90, "", None, "Ünï code words " * 150, "a\x0bb\x1cc\rd\te\x0cf" * 60, "x" * 3_000_000 + " y" * 1_500_000, "$ A B C"]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(90)]
    docs += [(7, texts[0], "en"), (7, texts[0], "de"), (7, texts[0], "de"), (None, texts[0], "en"), (None, texts[0], "en"), (-3, texts[3], None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(30)] + [(None, 1, 1), (3, 1, 0), (3, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit(5) for c in ("A", "E", "part", "good", "digest", "first", "all", "all_0")})
    ls = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({c: F.lit(5) for c in ("A", "good", "part", "text")})
    got = audit.audit(audit.flagged(d, ls)).collect()
    want = brute_audit(docs, labels)
    assert len(got) == len(want) == 600 * len({lang or "" for *_, lang in docs})
    for r in got:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] == want[r.part, r.filter_order, r.step]
    assert audit.audit(audit.flagged(d.limit(0), ls)).count() == 0
    assert audit.audit(audit.flagged(d, ls.limit(0))).agg(F.sum("good_lost")).first()[0] == 0


# 13


def test_dominance_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, *range(-40, 90)]), rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 5])) for i in range(700)]
    rows += [(1, 3, 3, 1)] * 50 + [(None, 80, 2, 1)]
    df = spark.createDataFrame(rows, "id long, a long, b long, c long").withColumns({k: F.lit("clash") for k in ("x", "y", "w", "n", "node", "__x", "edge", "sx")})
    got = dominance.dominance(df, F.col("a"), F.col("b"), F.col("c"), "n_sales", "n_rows")
    assert got.columns == [*df.columns, "n_sales", "n_rows"]
    above = lambda a, b: [r for r in rows if None not in (a, b, r[1], r[2]) and r[1] < a and r[2] > b]
    want = [(i, a, b, c, *((None, None) if None in (a, b) else (len(above(a, b)), sum(r[3] or 0 for r in above(a, b))))) for i, a, b, c in rows]
    key = lambda r: [(-1, 0) if x is None else (0, x) for x in r]
    assert sorted((tuple(r) for r in got.select("id", "a", "b", "c", "n_sales", "n_rows").collect()), key=key) == sorted(want, key=key)
    assert dominance.dominance(df.limit(0), F.col("a"), F.col("b"), F.lit(1)).count() == 0
    assert dominance.dominance(df.where("a IS NULL"), F.col("a"), F.col("b"), F.lit(1)).select("n").distinct().collect()[0][0] is None


def test_node_over_many_partitions(spark):
    """One x has half of all rows and one y a third; sums run on over the edges of partitions."""
    n = 20_000
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 64).alias("a"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 37 % 1009).alias("b"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {(r.a, r.b): r.n for r in dominance.dominance(df, F.col("a"), F.col("b"), F.lit(2)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    a, b = (np.array([r[k] for r in df.collect()]) for k in ("a", "b"))
    for (x, y), m in list(got.items())[::7]:
        assert m == int(((a < x) & (b > y)).sum())


def test_carried_sums():
    assert dominance.carried([(0, 1, 2, 5, 6), (1, 2, 2, 3, 3), (3, 2, 9, 1, 1), (4, 9, 9, 0, 0), (5, 10, 10, 4, 4)]) == [(1, 5, 6), (3, 8, 9), (4, 1, 1)]


def test_minutes_do_not_depend_on_the_session(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:59.9' AS t UNION ALL SELECT timestamp_ntz'1969-12-31 23:59:59.5' UNION ALL SELECT CAST(NULL AS timestamp_ntz)")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = {r[0] for r in rows.select(dominance.minute(rows, "t")).collect()}
            assert got == {calendar.timegm((2024, 3, 10, 2, 30, 59)) // 60, -1, None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weights_and_levels(spark):
    ids = [0, 7, 123456, -5]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select(F.crc32(F.col("i").cast("string").cast("binary")) % 5).collect()
    assert [r[0] for r in got] == [zlib.crc32(str(i).encode()) % 5 for i in ids]
    levels = spark.createDataFrame([(1.005,), (None,), (float("nan"),), (float("inf"),), (-0.015,)], "t double").select(dominance.cents(F.col("t"))).collect()
    assert [r[0] for r in levels] == [math.floor(100 * 1.005 + 0.5), None, None, None, math.floor(100 * -0.015 + 0.5)]

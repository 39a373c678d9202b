"""Audit of how filters interact, by inclusion and exclusion.

Each document has one flag for each filter that it fails. For every set of filters
the documents failing all of them are counted: the sum of the product of the set's
flags, 32 sums for five filters, which combine before the shuffle. All figures
follow from these joint counts J(S) by Moebius inversion: survivors of a set P are
the alternating sum of J over its subsets; documents failing exactly one filter the
alternating sum over the sets that hold it; and, as J(S) with its sign is the
Harsanyi dividend of S for the number removed, a filter's Shapley value is the sum
of the dividends of its sets, each shared equally (times the number of orders, a whole number).
The same sums over good and over toxic documents give what is lost of them.

Cases: a null text is empty; a null lang is the part ''; every row counts, repeated
ones too; a document is a copy if a row with a smaller doc_id has the same text, so
rows of equal doc_id, and rows without one, are no copies of each other; rows without doc_id have
no labels and hide no one; of a doc_id's labels one that is 1 is enough; an empty
table gives no rows. Columns beyond those read have no influence.
"""

from __future__ import annotations

import re
import string
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Store, map_texts, table

FILTERS = "ABCDE"
#: Thresholds: words, per cent of distinct words, per cent of capitals.
WORDS, DISTINCT, CAPITALS = 200, 50, 3
CAPITAL, MARKS = string.ascii_uppercase.encode(), b"#$%&*|"
GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are split at a time.
PIECE = 1 << 20


def measures(text: str) -> tuple[int, int, int, int]:
    """Words, distinct words, letters A to Z, and characters of the marks; a long text is split piece by piece."""
    data = text.encode()
    words, seen, at = 0, set(), 0
    while at < len(data):
        end = GAP.search(data, at + PIECE)
        piece = data[at : end.start() if end else len(data)].split()  # splits at these very white spaces
        words, at = words + len(piece), end.start() if end else len(data)
        seen.update(piece)
    return words, len(seen), len(data) - len(data.translate(None, CAPITAL)), len(data) - len(data.translate(None, MARKS))


def text_flags(texts: list[str]) -> dict[str, list[int]]:
    """The filters that each text fails by itself, 1 or 0."""
    out: dict[str, list[int]] = {k: [] for k in "ABCD"}
    for text in texts:
        words, distinct, capitals, marks = measures(text)
        fails = words < WORDS, 100 * distinct < DISTINCT * words, 100 * capitals > CAPITALS * len(text), marks > 0
        for k, f in zip("ABCD", fails, strict=True):
            out[k].append(int(f))
    return out


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, the flags A to E, good and toxic (0 or 1) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    store = Store(docs.sparkSession, "audit")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    rows = store.keep(map_texts(rows, text_flags, "A int, B int, C int, D int"))
    firsts = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    said = said.agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    # Both joins have the id in their key, so copies of one text, however many, are dealt out.
    with_id = rows.where("doc_id IS NOT NULL").join(firsts.withColumn("first", F.lit(True)), ["doc_id", "digest"], "left").join(said, "doc_id", "left")
    with_id = with_id.withColumn("E", F.col("first").isNull().cast("int"))
    without = rows.where("doc_id IS NULL").withColumns({"E": F.lit(0), "good": F.lit(0), "toxic": F.lit(0)})
    columns = ["part", *FILTERS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]]
    return with_id.select(*columns).unionByName(without.select(*columns))


def joint_counts(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part the arrays ``all``, ``good`` and ``toxic``: at place S (bits by filter) the documents failing every filter of S."""
    subsets = range(1 << len(filters))
    factors = lambda s, start: " * ".join([start, *[f for i, f in enumerate(filters) if s >> i & 1]])
    sums = [F.expr(f"sum(CAST({factors(s, start)} AS LONG)) AS {name}_{s}") for name, start in (("all", "1"), ("good", "good"), ("toxic", "toxic")) for s in subsets]
    return flags.groupBy("part").agg(*sums).select("part", *[F.expr(f"array({', '.join(f'{name}_{s}' for s in subsets)}) AS {name}") for name in ("all", "good", "toxic")])


def survivors(joint: str, p: int) -> str:
    """SQL of the documents that fail no filter of ``p``."""
    return " ".join(f"{'-' if s.bit_count() & 1 else '+'} {joint}[{s}]" for s in range(p + 1) if s & p == s)


def failing_only(joint: str, i: int, n: int) -> str:
    """SQL of the documents that fail filter ``i`` and no other."""
    return " ".join(f"{'+' if s.bit_count() & 1 else '-'} {joint}[{s}]" for s in range(1 << n) if s >> i & 1)


def shapley(joint: str, i: int, n: int) -> str:
    """SQL of filter ``i``'s removals summed over all orders: its sets' dividends in equal shares, times n!."""
    return " ".join(f"{'+' if s.bit_count() & 1 else '-'} {factorial(n) // s.bit_count()} * {joint}[{s}]" for s in range(1 << n) if s >> i & 1)


def audit(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step."""
    n = len(filters)
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, i in enumerate(order):
            steps.append(f"('{''.join(filters[j] for j in order)}', {k + 1}, {i}, {before}, {before | 1 << i})")
            before |= 1 << i
    array = lambda parts, name: F.expr(f"array({', '.join(parts)}) AS {name}")
    left = [array([survivors(c, p) for p in range(1 << n)], f"{c}_left") for c in ("all", "good", "toxic")]
    alone, value, fails = ([f(i) for i in range(n)] for f in (lambda i: failing_only("all", i, n), lambda i: shapley("all", i, n), lambda i: f"all[{1 << i}]"))
    by_part = joint_counts(flags, filters).select("part", *left, array(alone, "alone"), array(value, "value"), array(fails, "fails"))
    by_step = by_part.select("*", F.expr(f"inline(array({', '.join(steps)})) AS (filter_order, step, i, p, q)"))
    lost = lambda c: f"{c}_left[p] - {c}_left[q]"
    return by_step.selectExpr(
        "part", "filter_order", "step", "all_left[q] AS kept", f"{lost('all')} AS removed", f"fails[i] - ({lost('all')}) AS redundant",
        "alone[i] AS unique_fails", f"{lost('good')} AS good_lost", f"{lost('toxic')} AS toxic_lost", "value[i] AS shapley",
    )


def op12_audit_filters(spark, sf_dir: str) -> DataFrame:
    return audit(flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


#: The filters applied step by step in each of the 120 orders.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d
), f AS (
  SELECT part, doc_id,
    (len(words) < 200) AS a, (100 * len(list_distinct(words)) < 50 * len(words)) AS b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM w
), l AS (
  SELECT doc_id, max(coalesce(CAST(quality = 1 AS INT), 0)) AS good, max(coalesce(CAST(toxic = 1 AS INT), 0)) AS toxic FROM labels GROUP BY doc_id
), g AS (
  SELECT f.part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [f.a, f.b, f.c, f.d, f.e][i]) AS fails,
    coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, count(*) AS n
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY ALL
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, unnest(range(1, 6)) AS step FROM o
), r AS (
  SELECT g.part, s.filter_order, s.step, substr(filter_order, CAST(step AS BIGINT), 1) AS filter, g.n, g.good, g.toxic, g.fails,
    list_contains(g.fails, substr(filter_order, CAST(step AS BIGINT), 1)) AS fails_here,
    len(list_filter(g.fails, lambda y: position(y IN filter_order) < step)) > 0 AS gone
  FROM g, s
), t AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN NOT gone AND NOT fails_here THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails_here THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails_here THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails_here AND len(fails) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails_here THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails_here THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM t
"""

"""Dominance counting by a distributed range tree.

A row stands above another if its ``x`` is smaller and its ``y`` strictly larger.
The tree is dyadic over x: a node at height b holds the values that agree but for
their last b bits. The values below an x are the disjoint union of the nodes to
the left of its path, one for each set bit; only left children ever stand there,
so at every height a value either adds itself to a left child (bit 0) or asks the
left child beside it (bit 1). Rows with equal x and y are summed first and travel as one.

All entries are ordered by (node, y from above, questions before values) over range
partitions of Spark: a node with many rows lies across as many partitions as it
needs. Within a partition sums run on; what a node has in earlier partitions is
added from one row of totals for each partition. Answers are summed by (x, y) and
joined with the rows.

Cases: rows whose x or y is null are above none and get null counts; ties in x or y
are not above each other; repeated rows count each; a null weight counts as 0; an
empty table gives an empty result; other columns stay, whatever their names, but
for those of the counts' names, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Store, packed, table

#: Widest span of x, in bits: a node's number has one bit more.
MOST_BITS = 60


def entries(cells: DataFrame, low: int, bits: int) -> DataFrame:
    """node, y, x, n and w: for each height a value of a left child (with n and w) or a question to one (without).

    A value's x is only there so that equal keys can be split; its last bits do.
    """
    at = F.col("x") - F.lit(low)
    rows = cells.select("x", "y", "n", "w", at.alias("at"), F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("b"))
    place = F.expr("shiftright(at, b)")
    asks = place.bitwiseAND(F.lit(1)) == 1
    node = F.expr(f"shiftleft(1L, {bits} - b)") + place - place.bitwiseAND(F.lit(1))
    return rows.select(
        node.alias("node"), "y", F.when(asks, F.col("x")).otherwise(F.col("at").bitwiseAND(F.lit(1023))).alias("x"),
        F.when(~asks, F.col("n")).alias("n"), F.when(~asks, F.col("w")).alias("w"),
    )


def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of a partition's questions: sums over the node's values before them in this partition.

    ``edge`` numbers the partition where its first node is asked, which may have begun
    earlier. The last row holds no x: first node (as y), last node, sums of the last node here.
    """
    names = ["x", "y", "n", "w", "edge", "last"]
    number = TaskContext.get().partitionId()
    first = last = None
    tail = np.zeros(2, dtype=np.int64)
    for b in batches:
        if not b.num_rows:
            continue
        node = b.column(0).to_numpy()
        asks = np.asarray(b.column(3).is_null())
        sums = np.stack([np.cumsum(b.column(i).fill_null(0).to_numpy()) for i in (3, 4)])
        if first is None:
            first = int(node[0])
        starts = np.flatnonzero(node[1:] != node[:-1]) + 1
        base = np.concatenate([-tail[:, None] if int(node[0]) == last else np.zeros((2, 1), np.int64), sums[:, starts - 1]], axis=1)
        run = np.zeros(len(node), dtype=np.int64)
        run[starts] = 1
        before = sums - base[:, np.cumsum(run)]
        last, tail = int(node[-1]), before[:, -1].copy()
        open_ = node == first
        at = np.flatnonzero(asks & (open_ | (before[0] > 0)))
        edge = pa.array(np.full(len(at), number, dtype=np.int32), mask=~open_[at])
        yield pa.RecordBatch.from_arrays([b.column(2).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(before[0, at]), pa.array(before[1, at]), edge, pa.nulls(len(at), pa.int64())], names=names)
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([first]), pa.array(tail[:1]), pa.array(tail[1:]), pa.array([number], pa.int32()), pa.array([last])], names=names)


def carried(totals: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(partition, n, w) that the first node of a partition has in earlier ones; from (partition, first, last, n, w) in order."""
    out, node, n, w = [], None, 0, 0
    for number, first, last, n_here, w_here in sorted(totals):
        if first != node:
            n = w = 0
        elif n or w:
            out.append((number, n, w))
        n, w = (n + n_here, w + w_here) if first == last else (n_here, w_here)
        node = last
    return out


def dominance(rows: DataFrame, x: Column, y: Column, weight: Column, count: str = "n", total: str = "w") -> DataFrame:
    """``rows`` with ``count``, the number of rows above each, and ``total``, the sum of their weights.

    ``x`` and ``y`` are whole numbers. The driver gets the least and greatest x and five numbers for each partition.
    """
    spark = rows.sparkSession
    store = Store(spark, "dominance")
    columns = [c for c in rows.columns if c not in (count, total)]
    base = packed(rows, x.cast("long").alias("x"), y.cast("long").alias("y"), F.coalesce(weight.cast("long"), F.lit(0)).alias("w"))
    placed = F.col("x").isNotNull() & F.col("y").isNotNull()
    whole = lambda df, n, w: df.select(*[F.col(f"__row.`{c}`").alias(c) for c in columns], n.cast("long").alias(count), w.cast("long").alias(total))
    without = whole(base.where(~placed), F.lit(None), F.lit(None))
    cells = store.keep(base.where(placed).groupBy("x", "y").agg(F.count("*").alias("n"), F.sum("w").alias("w")))
    low, high = cells.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return without
    bits = max(1, (high - low).bit_length())
    if bits > MOST_BITS:
        raise ValueError(f"x spans {bits} bits; {MOST_BITS} at most")
    order = [F.col("node"), F.col("y").desc(), F.col("n").asc_nulls_first(), F.col("x")]
    dealt = entries(cells, low, bits).repartitionByRange(*order).sortWithinPartitions(*order)
    answers = store.keep(dealt.mapInArrow(running, "x long, y long, n long, w long, edge int, last long"))
    store.drop(cells)
    totals = answers.where("x IS NULL").select("edge", "y", "last", "n", "w").collect()
    earlier = spark.createDataFrame(carried([tuple(t) for t in totals]), "edge int, n_before long, w_before long")
    added = answers.where("x IS NOT NULL").join(F.broadcast(earlier), "edge", "left")
    plus = lambda c: F.sum(F.col(c) + F.coalesce(F.col(f"{c}_before"), F.lit(0)))
    # Written, so that in the join both sides are dealt anew and Spark can split a hot cell's rows.
    summed = store.keep(added.groupBy(F.col("x").alias("sx"), F.col("y").alias("sy")).agg(plus("n").alias("sn"), plus("w").alias("sw")))
    store.drop(answers)
    found = base.where(placed).join(summed, (F.col("x") == F.col("sx")) & (F.col("y") == F.col("sy")), "left")
    return whole(found, F.coalesce("sn", F.lit(0)), F.coalesce("sw", F.lit(0))).unionByName(without)


def minute(df: DataFrame, column: str) -> Column:
    """Minutes since 1970 of a time without a zone, taken as UTC; of a time with one, its own. The session's zone has no say."""
    if df.schema[column].dataType.simpleString() == "timestamp_ntz":
        return F.unix_date(F.col(column).cast("date")).cast("long") * 1440 + F.hour(column) * 60 + F.minute(column)
    return F.floor(F.floor(F.unix_micros(F.col(column)) / 1_000_000) / 60)


def cents(total: Column) -> Column:
    """floor(100 * total + 0.5); null for null and what is no finite number."""
    finite = total.isNotNull() & ~F.isnan(total) & (F.abs(total) < F.lit(float("inf")))
    return F.when(finite, F.floor(F.floor(F.lit(100.0) * total + F.lit(0.5)) / 1))


def op13_count_dominance(spark, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "sales")
    rows = sales.select("sale_id", minute(sales, "sold_at").alias("slot"), cents(F.col("total")).alias("level"))
    weight = F.lit(1) + F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5, F.lit(0))
    return dominance(rows, F.col("slot"), F.col("level"), weight, "n_sales", "n_rows")


#: All pairs; crc32 bit by bit, as SQL has no such function.
ORACLE = """
WITH s AS (
  SELECT sale_id, CAST(floor(floor(epoch(sold_at)) / 60) AS BIGINT) AS slot, CAST(floor(floor(100 * total + 0.5) / 1) AS BIGINT) AS level,
    CAST(sale_id AS VARCHAR) AS digits FROM sales
), c AS (
  SELECT sale_id, slot, level, 1 + xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(8 * length(digits)), lambda i: CAST(CASE WHEN i % 8 = 0 THEN ascii(substr(digits, CAST(i // 8 + 1 AS BIGINT), 1)) ELSE 0 END AS BIGINT))),
    lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), CAST(4294967295 AS BIGINT)) % 5 AS weight FROM s
), p AS (
  SELECT q.sale_id, count(*) AS n, sum(a.weight) AS w FROM c q JOIN c a ON a.slot < q.slot AND a.level > q.level GROUP BY q.sale_id
)
SELECT c.sale_id, c.slot, c.level,
  CASE WHEN c.slot IS NOT NULL AND c.level IS NOT NULL THEN coalesce(p.n, 0) END AS n_sales,
  CAST(CASE WHEN c.slot IS NOT NULL AND c.level IS NOT NULL THEN coalesce(p.w, 0) END AS BIGINT) AS n_rows
FROM c LEFT JOIN p ON c.sale_id = p.sale_id
"""

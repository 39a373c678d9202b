"""Exact top-k by inner product: exhaustive accumulation, one term at a time.

A row's components become whole numbers; those that are not zero are its terms. Rows
are dealt evenly to blocks, queries to blocks of their own, and every pair of blocks
meets in one place. There the candidates' terms are turned into postings (rows and
weights by term). Each term of a query row scatters its weighted postings into a dense
array with one score for each candidate; nothing is skipped. The k best of an array are
selected by partition, and the answers of all blocks are merged.

Both kinds of blocks are of bounded size, so memory does not grow with the input; what
is computed is queries times rows, as asked for.

Cases: vectors that are null or hold null or non-finite components take no part, nor do
rows without an id; zero and empty vectors do, with score 0; components that a shorter
vector lacks count as 0; rows that share an id are one candidate and one query, their
highest score counting; ties go to the smaller vec_id; all candidates are returned
where there are fewer than k; an empty table gives an empty result; scores are exact at any
size of components, and one beyond 64 bits counts as the nearest that 64 bits hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

SCALE = 1024
#: Components of a block of candidates and of one of queries, on average.
CANDIDATES, QUERIES = 1 << 19, 1 << 19
LONG = np.iinfo(np.int64)


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as int64 or, where that is too narrow, as Python's integers."""
    y = np.floor(scale * x)
    if not len(x) or np.abs(y).max() < 2.0**62:
        return y.astype(np.int64)
    # From 2^53 on a double is whole itself, and the product may leave the doubles.
    return np.array([int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(scale * v)) for v in x.tolist()], dtype=object)


def terms(lengths: np.ndarray, x: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, term and weight of the components that are not zero, by row."""
    weight = whole(x, scale)
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    on = np.flatnonzero(weight)
    return row[on], term[on], weight[on]


class Postings:
    """Candidates by term, ordered by id; rows of one id are told by ``heads`` where ids repeat."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, x: np.ndarray, scale: int):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        row, term, weight = terms(lengths, x, scale)
        by = np.argsort(term, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], np.diff(term[by]) != 0))) if len(by) else np.zeros(0, np.int64)
        self.lists = {int(term[by[i]]): (place[row[part]], weight[part]) for i, part in zip(edge, np.split(by, edge[1:]), strict=True)}
        self.size, self.ids = len(ids), ids[order]
        heads = np.flatnonzero(np.concatenate(([True], np.diff(self.ids) != 0)))
        self.heads = heads if len(heads) < len(ids) else None
        if self.heads is not None:
            self.ids = self.ids[heads]
        self.largest = int(np.abs(weight).max()) if len(weight) else 0

    def narrow(self, dtype: type) -> Postings:
        """Itself, with weights of ``dtype``."""
        self.lists = {t: (r, w.astype(dtype)) for t, (r, w) in self.lists.items()}
        return self

    def scores(self, term: np.ndarray, weight: np.ndarray, dtype: type) -> np.ndarray:
        """Every candidate's score for one query row."""
        out = np.zeros(self.size, dtype=dtype)
        for t, w in zip(term.tolist(), weight.tolist(), strict=True):
            if t in self.lists:
                rows, weights = self.lists[t]
                out[rows] += weights * dtype(w) if dtype is not object else weights * w
        out = np.clip(out, LONG.min, LONG.max).astype(np.int64) if dtype is object else out
        return out if self.heads is None else np.maximum.reduceat(out, self.heads)

    def best(self, query: int, score: np.ndarray, k: int) -> np.ndarray:
        """Places of the k highest scores but the query's own, ties to smaller ids."""
        own = np.searchsorted(self.ids, query)
        others = np.delete(np.arange(len(score)), own) if own < len(self.ids) and self.ids[own] == query else np.arange(len(score))
        if len(others) <= k:
            return others
        mine = score[others]
        bound = np.partition(mine, len(mine) - k)[len(mine) - k]
        above = np.flatnonzero(mine > bound)
        return others[np.concatenate([above, np.flatnonzero(mine == bound)[: k - len(above)]])]


def search(rows: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the k highest integer inner products of every row with ``is_query``.

    What the driver gets is two numbers of rows and of components.
    """
    kind = "float" if rows.schema[vector].dataType.simpleString() == "array<float>" else "double"
    exact = np.dtype(np.float32 if kind == "float" else np.float64)
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    asked = cut(base.where("q").select("vec_id", "v").distinct())
    volume = lambda df: df.agg(F.coalesce(F.sum(F.size("v") + F.lit(1)), F.lit(0))).first()[0]
    c, q = (-(-volume(df) // most) for df, most in ((base, candidates), (asked, queries)))
    if not q:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    names = ["pair", "asks", "ids", "lengths", "data"]

    def dealer(asks: bool):
        """Rows in turn to the blocks of their kind, each block's to all its pairs; a pair's rows of a batch are one row of bytes."""
        own, other = (q, c) if asks else (c, q)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = None
            for b in batches:
                if not b.num_rows:
                    continue
                ids, lists = b.column(0).to_numpy(), b.column(1)
                ends = np.cumsum(lists.value_lengths().to_numpy())
                x = lists.flatten().to_numpy(zero_copy_only=False).astype(exact, copy=False)
                # Parts of the table begin at different blocks.
                at = int(ids[0]) if at is None else at
                block = (at + np.arange(len(ids))) % own
                at += len(ids)
                for mine in np.unique(block):
                    r = np.flatnonzero(block == mine)
                    data = b"".join([x[(ends[i - 1] if i else 0) : ends[i]].tobytes() for i in r])
                    lengths = np.diff(ends, prepend=0)[r].astype(np.int32)
                    pairs = mine + q * np.arange(other) if asks else mine * q + np.arange(other)
                    for p in pairs.tolist():
                        yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([asks]), pa.array([ids[r].tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary()), pa.array([data], pa.binary())], names=names)

        return deal

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each pair of blocks; a pair's candidates come before its queries."""
        now, parts, postings = None, [], None
        for b in batches:
            for pair, asks, i, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), b.column(4), strict=True):
                if pair != now:
                    now, parts, postings = pair, [], None
                part = np.frombuffer(i.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int32), np.frombuffer(x.as_buffer(), exact).astype(np.float64)
                if not asks:
                    parts.append(part)
                    continue
                if not parts:
                    continue
                if postings is None:
                    postings = Postings(*[np.concatenate(z) for z in zip(*parts, strict=True)], scale)
                ids, lengths, values = part
                row, term, weight = terms(lengths, values, scale)
                longest = int(lengths.max(initial=0))
                bound = postings.largest * (int(np.abs(weight).max()) if len(weight) else 0) * longest
                dtype = np.int32 if max(bound, postings.largest) < 2**31 else np.int64 if max(bound, postings.largest) < 2**63 else object
                postings.narrow(dtype)
                edge = np.searchsorted(row, np.arange(len(ids) + 1))
                found = []
                for j, query in enumerate(ids.tolist()):
                    own = slice(edge[j], edge[j + 1])
                    score = postings.scores(term[own], weight[own], dtype)
                    top = postings.best(query, score, k)
                    found.append((np.full(len(top), query), postings.ids[top], score[top].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    schema = "pair long, asks boolean, ids binary, lengths binary, data binary"
    dealt = base.select("vec_id", "v").mapInArrow(dealer(False), schema).unionByName(asked.mapInArrow(dealer(True), schema))
    met = dealt.repartition("pair").sortWithinPartitions("pair", "asks")
    found = met.mapInArrow(answer, "query_id long, vec_id long, score long").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_search_exact(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p
)
SELECT * FROM r WHERE rank <= 10
"""

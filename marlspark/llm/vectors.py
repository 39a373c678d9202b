"""Approximate nearest neighbours by shifted space-filling curves.

Each of several random rotations projects all vectors to a few dimensions; the
projections, shifted at random and quantised, are ordered along a Hilbert curve.
Every order is cut into blocks of equally many rows (approximate quantiles of its
keys, from all rows), larger blocks into parts of bounded size. What is dealt to a part are
ids and 8-bit codes of its rows, with the exact length of each code's error. A query
goes, exact, to its own block and to those beside it; a part bounds its rows' distances
from below and above and returns those that may be among the query's nearest there. The parts'
answers are merged, rows that k others are surely nearer than go, and the rest are ranked
again by double-precision distances of the original vectors. Codes so lose nothing of a window.

A window is five blocks of ``blocks`` and so a share of an order: recall holds at every size, and a query
is compared with at most 5 * curves / blocks of all rows. Queries stream by a part's
rows, however many they are. Few rows make one block, which is exact.

Cases: vectors that are null, empty, zero or hold null or non-finite values take
no part; nor do rows without an id; rows that share an id are one candidate, the
nearest of them counting, and one query; ties go to the smaller vec_id; all candidates are returned where there are
fewer than k; an empty table gives an empty result; vectors of other dimensions
than the first kept by order of id are not comparable and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Orders, dimensions and bits of each, blocks of an order, blocks beside a query's own, rows of a part.
CURVES, DIMENSIONS, BITS, BLOCKS, BESIDE, PART = 36, 8, 4, 270, 2, 4096
#: Share of the squared lengths that single-precision products may be off by.
ROUNDING = 1e-5


def coded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit codes of vectors, their scales, and a bound of the length of each one's error."""
    scale = (np.abs(v).max(axis=1) / 127).astype(np.float64)
    scale[scale == 0] = 1.0
    code = np.rint(v / scale[:, None]).clip(-127, 127).astype(np.int8)
    off = v - code * scale[:, None]
    return code, scale, np.sqrt((off * off).sum(axis=1)) * (1 + 1e-9)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer cells (n by d) along the Hilbert curve, by Skilling's transposed form."""
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def usable(v: Column) -> Column:
    ok = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    return v.isNotNull() & F.coalesce(F.forall(v, ok), F.lit(False)) & F.coalesce(F.exists(v, lambda e: e != 0), F.lit(False))


def search(rows: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, blocks: int = BLOCKS, beside: int = BESIDE, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the nearest rows found for every row with ``is_query``.

    All other rows are candidates. What the driver gets is the dimension, the number
    of rows, each projected dimension's bounds, and quantiles and counts by curve and
    block: sizes that the parameters fix.
    """
    spark = rows.sparkSession
    kind = "float" if rows.schema[vector].dataType.simpleString() == "array<float>" else "double"
    exact = np.dtype(np.float32 if kind == "float" else np.float64)
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("v"), is_query.alias("q")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    head = base.agg(F.count("*").alias("n"), F.min_by(F.size("v"), "vec_id").alias("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not head["n"]:
        return spark.createDataFrame([], schema)
    d = head["d"]
    p = min(dimensions, d)
    base = base.where(F.size("v") == d)
    rng = np.random.default_rng(seed)
    rotations = [np.linalg.qr(rng.normal(size=(d, d)))[0][:, :p] for _ in range(curves)]
    basis, shifts = np.concatenate(rotations, axis=1), rng.uniform(size=(curves, p))

    # Mean and spread of every projected dimension, from all rows.
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(0).flatten().to_numpy().reshape(-1, d).astype(np.float64) @ basis
            c = y.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(c)), pa.array(np.full(c, float(len(y)))), pa.array(y.sum(axis=0)), pa.array((y * y).sum(axis=0))], names=["c", "n", "s", "s2"])

    got = base.select("v").mapInArrow(moments, "c long, n double, s double, s2 double").groupBy("c").agg(F.sum("n"), F.sum("s"), F.sum("s2")).orderBy("c").collect()
    n, s, s2 = (np.array([r[i] for r in got]) for i in (1, 2, 3))
    mean = s / n
    spread = np.sqrt(np.maximum(s2 / n - mean**2, 1e-24))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1).flatten().to_numpy().reshape(-1, d)
            y = ((v.astype(np.float64) @ basis - mean) / spread / 6 + 0.5).clip(0, 1).reshape(len(v), curves, p)
            cells = np.minimum(((y + shifts) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1)
            key = np.stack([hilbert(cells[:, c], bits) for c in range(curves)], axis=1)
            offsets = pa.array(np.arange(0, key.size + 1, curves, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in v], pa.binary()), b.column(2), pa.ListArray.from_arrays(offsets, pa.array(key.ravel()))], names=["vec_id", "v", "q", "keys"])

    keyed = cut(base.select("vec_id", "v", "q").mapInArrow(keys, "vec_id long, v binary, q boolean, keys array<long>"))
    cuts = max(1, min(blocks, int(head["n"]) // 64))
    exploded = keyed.select(F.posexplode("keys").alias("curve", "key"))
    steps = [i / cuts for i in range(1, cuts)]
    edges = {r[0]: sorted(set(r[1])) for r in exploded.groupBy("curve").agg(F.percentile_approx("key", F.array(*map(F.lit, steps)), 10_000)).collect()} if steps else {}
    edges = [np.array(edges.get(c, []), dtype=np.int64) for c in range(curves)]

    def place(key: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(edges[c], key[:, c], side="right") for c in range(curves)], axis=1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = place(b.column(0).flatten().to_numpy().reshape(-1, curves))
            c = np.broadcast_to(np.arange(curves), at.shape)
            pair, count = np.unique(np.stack([c.ravel(), at.ravel()]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(count)], names=["curve", "block", "n"])

    sizes = {(r[0], r[1]): r[2] for r in keyed.select("keys").mapInArrow(placed, "curve long, block long, n long").groupBy("curve", "block").agg(F.sum("n")).collect()}
    parts = np.ones((curves, cuts + 1), dtype=np.int64)
    for (c, b), m in sizes.items():
        parts[c, b] = -(-m // PART)

    first = np.zeros(parts.size + 1, dtype=np.int64)  # number of each block's first part
    np.cumsum(parts.ravel(), out=first[1:])

    def packed_rows(number: np.ndarray, row: np.ndarray, ids: np.ndarray, data: np.ndarray, asks: bool) -> Iterator[pa.RecordBatch]:
        """Rows by part, those of one part as one row of bytes."""
        order = np.argsort(number, kind="stable")
        number, row = number[order], row[order]
        edge = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True]))) if len(number) else np.zeros(1, np.int64)
        for i in range(0, len(edge) - 1, 4096):
            part = list(zip(edge[i : min(i + 4096, len(edge) - 1)], edge[i + 1 : i + 4097], strict=True))
            at = pa.array([number[x] for x, _ in part], pa.int64())
            yield pa.RecordBatch.from_arrays([at, pa.array([asks] * len(part)), pa.array([ids[row[x:z]].tobytes() for x, z in part], pa.binary()), pa.array([data[row[x:z]].tobytes() for x, z in part], pa.binary())], names=["part", "asks", "ids", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row's code to one part of its block on each curve; a query, exact, to all parts of its own and the neighbouring blocks."""
        for b in batches:
            ids = b.column(0).to_numpy()
            query = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            v = np.frombuffer(b"".join(b.column(1).to_pylist()), exact).reshape(-1, d)
            at = place(b.column(3).flatten().to_numpy().reshape(-1, curves))
            code, scale, off = coded(v.astype(np.float64))
            data = np.concatenate([code.view(np.uint8), scale[:, None].view(np.uint8), off[:, None].view(np.uint8)], axis=1)
            row, curve = np.divmod(np.arange(at.size), curves)
            block = curve * (cuts + 1) + at.ravel()
            part = (ids[row] * 2654435761 >> 7) % parts.ravel()[block]
            yield from packed_rows(first[block] + part, row, ids, data, False)
            for i in range(0, int(query.sum()), 64):
                r = np.flatnonzero(query)[i : i + 64]
                number, who = [], []
                for c in range(curves):
                    last = len(edges[c])
                    for x in range(-beside, beside + 1):
                        beyond = at[r, c] + x
                        ok = (beyond >= 0) & (beyond <= last)
                        blocks_ = c * (cuts + 1) + beyond[ok]
                        m = parts.ravel()[blocks_]
                        number.append(np.repeat(first[blocks_], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m))
                        who.append(np.repeat(r[ok], m))
                yield from packed_rows(np.concatenate(number), np.concatenate(who), ids, v, True)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bounds of the distances of a query's possible nearest rows; a part's rows come before the queries that pass by them."""
        now, ids, held, rows_ = None, [], [], None
        for b in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for number, asks, i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                if number != now:
                    now, ids, held, rows_ = number, [], [], None
                i = np.frombuffer(i.as_buffer(), np.int64)
                if not asks:
                    ids.append(i)
                    held.append(np.frombuffer(data.as_buffer(), np.uint8).reshape(len(i), d + 16))
                    continue
                if not ids:
                    continue
                if rows_ is None:
                    raw = np.concatenate(held)
                    scale, off = (np.ascontiguousarray(raw[:, d + 8 * j : d + 8 * j + 8]).view(np.float64)[:, 0] for j in (0, 1))
                    x = (np.ascontiguousarray(raw[:, :d]).view(np.int8) * scale[:, None]).astype(np.float32)
                    rows_ = np.concatenate(ids), x, (x.astype(np.float64) ** 2).sum(axis=1), off
                known, x, norm, off = rows_
                y = np.frombuffer(data.as_buffer(), exact).reshape(len(i), d).astype(np.float64)
                own = (y * y).sum(axis=1)
                with np.errstate(over="ignore", invalid="ignore"):
                    square = norm[None, :] + own[:, None] - 2 * (y.astype(np.float32) @ x.T).astype(np.float64)
                    slack = ROUNDING * (norm[None, :] + own[:, None])
                    low = np.sqrt(np.maximum(square - slack, 0)) - off[None, :]
                    high = np.sqrt(np.maximum(square + slack, 0)) + off[None, :]
                # What overflows is not bounded and stays a candidate.
                wild = ~np.isfinite(low) | ~np.isfinite(high)
                low[wild], high[wild] = 0.0, np.inf
                low[i[:, None] == known[None, :]], high[i[:, None] == known[None, :]] = np.inf, np.inf
                bound = np.partition(high, k - 1, axis=1)[:, k - 1] if len(known) > k else np.full(len(i), np.inf)
                r, c = np.nonzero((low <= bound[:, None]) & (low < np.inf))
                out.append((i[r], known[c], low[r, c], high[r, c]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in zip(*out, strict=True)], names=["query_id", "vec_id", "low", "high"])

    dealt = keyed.mapInArrow(deal, "part long, asks boolean, ids binary, data binary").repartition("part").sortWithinPartitions("part", "asks")
    found = dealt.mapInArrow(answer, "query_id long, vec_id long, low double, high double").groupBy("query_id", "vec_id").agg(F.min("low").alias("low"), F.min("high").alias("high"))
    by_query = Window.partitionBy("query_id")
    place_ = F.row_number().over(by_query.orderBy("high", "vec_id"))
    bound = F.max(F.when(F.col("n") <= k, F.col("high"))).over(by_query)
    left = found.withColumn("n", place_).withColumn("bound", bound).where("low <= bound").select("query_id", "vec_id")
    mine = keyed.where("q").select(F.col("vec_id").alias("query_id"), F.col("v").alias("y"))
    pairs = left.join(keyed.select("vec_id", F.col("v").alias("x")), "vec_id").join(mine, "query_id").select("query_id", "vec_id", "x", "y")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), exact).reshape(-1, d).astype(np.float64) for c in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))], names=["query_id", "vec_id", "score"])

    ranked = pairs.mapInArrow(measure, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(by_query.orderBy("score", "vec_id"))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_nearest_vectors(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)

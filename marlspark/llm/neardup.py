"""Near-duplicate documents by BagMinHash signatures, bands and exact multiset overlap.

A document is the multiset of its five-word shingles. BagMinHash: every shingle
owns Poisson processes over the discretised weights (0, 1], (1, 2], (2, 4], ...;
a point has an arrival time, a signature component and a weight level, and counts
for a document if that level is at most the shingle's weight there. A component's
value is its earliest point, so two documents agree in a component with
probability equal to their weighted Jaccard similarity. Points are generated
lazily, in order of time, only up to the time by which all components are filled.

Documents with equal multisets are one node. Nodes that share a band are in one
bucket. Three steps verify them, always exactly, on the multisets, and their number does not
depend on the data:

1. Each node is compared with its buckets' leaders (the most central node of each).
   Links are joined to components; a bucket all of one component is done.
2. Nodes of buckets that are still open are searched further by their prefixes: shingles are
   ordered from rare to common, and of two nodes at or above the similarity, the larger has
   one of the other's first 11% among its own first 20%. Nodes of different components that
   meet so, with sizes and places that allow the similarity, are compared;
   where more than ``FEW`` nodes share a shingle, each is compared with their leader.
3. What step 2 left open in the groups larger than that is compared in the same way, pair by pair.

No link between components is lost to a bound, and the pairs of a group are not listed: links
within a component need no look. Groups and leaders that hold many rows are split.

Cases: null and empty texts, and texts without words, have the empty multiset and
are one class; a text of fewer than five words is one shingle; rows with equal id
and text are one document and share a class; null ids are allowed, and a class
of them alone has a null class_id (class_key tells it); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import U, mix, shingles, uniform, words
from .common import Store, chunks, map_texts, packed, row_key, table

WORDS = 5
SIMILARITY = 0.8
COMPONENTS = 96
ROWS = 4  # of a band
FEW = 64  # nodes that share a shingle of their prefixes and are compared without a leader
GROUP = 256  # nodes of one leader, or of one shingle, that a task takes together
CELLS = 1 << 18  # counters that tell rare shingles from common ones
STEPS = 100_000  # edges of a partition in the loop that joins components
_GAMMA = U(0x9E3779B97F4A7C15)


def multiset(texts: list[str], k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle codes in order, their multiplicities and their texts, by text."""
    code, doc = shingles(*words(texts), k)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    parts = [np.unique(code[a:b], return_counts=True) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])


def signatures(code: np.ndarray, weight: np.ndarray, doc: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash: earliest arrival times of n documents by m components; infinity for empty documents."""
    out = np.full(n * m, np.inf)
    total = np.bincount(doc, weights=weight, minlength=n)
    todo = total > 0
    horizon = (np.log(m) + 5) / np.maximum(total, 1)
    while todo.any():
        use = todo[doc]
        c, w, d = code[use], weight[use], doc[use]
        levels = np.ceil(np.log2(np.maximum(w, 1))).astype(np.int64) + 1  # intervals of weight that w reaches into
        item = np.repeat(np.arange(len(c)), levels)
        j = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
        width = np.where(j > 0, 2.0 ** (j - 1), 1.0)
        low = np.where(j > 0, width, 0.0)  # the interval is (low, low + width]
        state = mix(c[item] + j.astype(np.uint64) * U(0xD6E8FEB86659FD93))
        time = np.zeros(len(item))
        limit = horizon[d[item]]
        owner, most = d[item], w[item]
        while len(state):
            state = state + _GAMMA
            r = mix(state)
            time = time - np.log(uniform(r)) / (m * width)
            on = time <= limit
            state, time, limit, owner, most, width, low, r = (x[on] for x in (state, time, limit, owner, most, width, low, r))
            if not len(state):
                break
            r = mix(r ^ U(0xA5A5A5A5A5A5A5A5))
            component = (r % U(m)).astype(np.int64)
            level = low + 1 + np.floor(uniform(mix(r)) * width * (1 - 1e-12))
            hit = level <= most
            np.minimum.at(out, owner[hit] * m + component[hit], time[hit])
        # A document with an unfilled component looks further ahead.
        todo &= np.isinf(out.reshape(n, m)).any(axis=1)
        horizon = np.where(todo, horizon * 2, horizon)
    return out.reshape(n, m)


def node_ids(code: np.ndarray, weight: np.ndarray, doc: np.ndarray, n: int) -> list[bytes]:
    """128 bits of each document's multiset, whatever its order."""
    out = []
    for salt in (U(0x1B873593), U(0xCC9E2D51)):
        x = mix(mix(code ^ salt) + weight.astype(np.uint64) * _GAMMA)
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(x, out=total[1:])
        edge = np.searchsorted(doc, np.arange(n + 1))
        out.append(mix(total[edge[1:]] - total[edge[:-1]]))
    return [a + b for a, b in zip(*([v.tobytes() for v in x.byteswap()] for x in out), strict=True)]


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(np.uint64)
    n, m = bits.shape
    out = np.zeros((n, m // rows), np.uint64)
    for i in range(rows):
        out = mix(out + bits[:, i : m // rows * rows : rows] + U((i + 1) * int(_GAMMA) & (2**64 - 1)))
    return out.view(np.int64)


def signed(docs: DataFrame, text: str) -> DataFrame:
    """Replace ``text`` by node (16 bytes) and bands."""

    def sign(texts: list[str]) -> dict[str, list]:
        code, weight, doc = multiset(texts)
        keys = bands(signatures(code, weight, doc, len(texts)))
        offsets = np.arange(0, keys.size + 1, keys.shape[1] or 1, dtype=np.int32)
        return {"node": pa.array(node_ids(code, weight, doc, len(texts)), pa.binary()), "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))}

    return map_texts(docs, sign, "node binary, bands array<long>", text)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, int]:
    """Weighted Jaccard similarity of two multisets and their overlap."""
    total = int(a[1].sum() + b[1].sum())
    shared = 0
    if len(a[0]) and len(b[0]):
        at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
        same = b[0][at] == a[0]
        shared = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return (shared / (total - shared) if total else 1.0), shared


def compared(pairs: DataFrame, texts: DataFrame, store: Store, similarity: float) -> DataFrame:
    """``pairs`` (node, leader) at or above the similarity; ``texts`` has node and text.

    A leader's text travels once for each ``GROUP`` of its nodes, ahead of theirs.
    """
    hot = pairs.groupBy("leader").agg(F.count("*").alias("c")).where(F.col("c") > GROUP)
    part = F.coalesce(F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / GROUP).cast("long")), F.lit(0).cast("long"))
    placed = store.keep(pairs.join(hot, "leader", "left").select("node", "leader", part.alias("part")))
    led = placed.select("leader", "part").distinct().join(texts.select(F.col("node").alias("leader"), "text"), "leader")
    both = led.select("leader", "part", F.lit(None).cast("long").alias("node"), "text").unionByName(placed.join(texts, "node").select("leader", "part", "node", "text"))
    both = both.repartition("leader", "part").sortWithinPartitions("leader", "part", F.col("node").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = None
        for batch in batches:
            who, node, text = batch.column(0).to_pylist(), batch.column(2).to_pylist(), [t or "" for t in batch.column(3).to_pylist()]
            kept, found = [], []
            for i, j in chunks(text):
                code, weight, doc = multiset(text[i:j])
                edge = np.searchsorted(doc, np.arange(j - i + 1))
                for k in range(i, j):
                    x = code[edge[k - i] : edge[k - i + 1]], weight[edge[k - i] : edge[k - i + 1]]
                    if node[k] is None:
                        leader = x
                    elif (s := overlap(x, leader)[0]) >= similarity:
                        kept.append(k)
                        found.append(s)
                if leader is not None and leader[0].base is not None:
                    leader = leader[0].copy(), leader[1].copy()
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([node[k] for k in kept], pa.int64()), pa.array([who[k] for k in kept], pa.int64()), pa.array(found, pa.float64())], names=["node", "leader", "similarity"])

    links = store.keep(both.mapInArrow(compare, "node long, leader long, similarity double"))
    store.drop(placed)
    return links


def components(links: DataFrame, store: Store) -> DataFrame:
    """node and component (one of its nodes) of all nodes in ``links`` (a, b).

    Nodes that no link points to hang on one of those that they point to. The loop,
    of alternating large and small stars, only sees the rest.
    """
    links = store.keep(links.where("a != b").distinct())
    first = links.groupBy("a").agg(F.min("b").alias("m"))
    hubs = store.keep(links.select(F.col("b").alias("node")).distinct())
    core = links.join(first, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    core = core.unionByName(first.join(hubs, first["a"] == hubs["node"], "left_semi").select(F.col("a").alias("u"), F.col("m").alias("v")))
    edges = store.keep(core.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), steady=True)
    state = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state()
    store.steady.conf.set("spark.sql.shuffle.partitions", str(max(8, before[0] // STEPS)))
    while before[0]:
        # Large star: all greater neighbours of a node go to the least of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(spread(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))), on_spread(both, "v")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node's smaller neighbours and the node itself go to the least of them.
        small = spread(large.groupBy("u").agg(F.min("v").alias("m")))
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        old, edges = edges, store.keep(large.join(small, on_spread(large, "v")).select(ends).select("e.u", "e.v").where("u != v").distinct(), steady=True)
        store.drop(old)
        after = state()
        if after == before:
            break
        before = after
    stars = store.spark.read.schema(edges.schema).parquet(store.path(edges))
    named = hubs.join(stars, hubs["node"] == stars["u"], "left").select("node", F.coalesce("v", "node").alias("component"))
    rest = first.join(hubs, first["a"] == hubs["node"], "left_anti").join(named.withColumnRenamed("node", "m"), "m").select(F.col("a").alias("node"), "component")
    found = store.keep(named.unionByName(rest))
    store.drop(links, hubs, edges)
    return found


def spread(df: DataFrame, parts: int = 8) -> DataFrame:
    """Copies of rows by u and part, to meet a node's many edges in several tasks."""
    return df.select(F.col("u").alias("u2"), "m", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))


def on_spread(df: DataFrame, other: str, parts: int = 8) -> list[Column]:
    return [df["u"] == F.col("u2"), F.pmod(F.xxhash64(df[other]), F.lit(parts)).cast("int") == F.col("part")]


def rarity(texts: DataFrame) -> np.ndarray:
    """By cell of shingles, how common they are in ``texts``, in steps of half a power of two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            text = [t or "" for t in b.column(0).to_pylist()]
            for i, j in chunks(text):
                total += np.bincount((multiset(text[i:j])[0] & U(CELLS - 1)).astype(np.int64), minlength=CELLS)
        some = np.flatnonzero(total)
        for x in range(0, len(some), 1 << 14):
            part = some[x : x + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["cell", "n"])

    counts = texts.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.floor(2 * F.log2(F.sum("n"))).cast("byte").alias("level")).where("level > 0").toArrow()
    out = np.zeros(CELLS, np.uint8)
    out[counts["cell"].to_numpy()] = counts["level"].to_numpy()
    return out


def prefixes(texts: list[str], level: np.ndarray, similarity: float) -> dict[str, list]:
    """Of each text: size of its multiset; its first shingles, from rare to common, with repeats as shingles of their own; how many of them are indexed.

    For two multisets at or above the similarity, the larger has one of the other's
    indexed shingles in its own prefix.
    """
    code, weight, doc = multiset(texts)
    item = np.repeat(np.arange(len(code)), weight)
    nth = np.arange(len(item)) - np.repeat(np.cumsum(weight) - weight, weight)
    token = np.where(nth > 0, mix(code[item] + nth.astype(np.uint64) * _GAMMA), code[item])
    order = np.lexsort((token, level[(code[item] & U(CELLS - 1)).astype(np.int64)], doc[item]))
    token, size = token[order].view(np.int64), np.bincount(doc[item], minlength=len(texts))
    start = np.cumsum(size) - size
    most = np.where(size > 0, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1, 0)
    indexed = np.where(size > 0, size - np.ceil(2 * similarity / (1 + similarity) * size - 1e-9).astype(np.int64) + 1, 0)
    return {"size": size, "indexed": indexed, "shingles": [token[a : a + m] for a, m in zip(start, most, strict=True)]}


def meeting(sits: DataFrame, similarity: float) -> DataFrame:
    """node and leader, once each, of different components that share a shingle of their prefixes and may reach the similarity."""
    parts = F.ceil(F.col("n") / GROUP).cast("int")
    x = sits.where("at < indexed").withColumn("part", F.explode(F.sequence(F.lit(1), parts))).alias("x")
    y = sits.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int") + 1).alias("y")
    smaller = (F.col("x.size") < F.col("y.size")) | ((F.col("x.size") == F.col("y.size")) & (F.col("x.node") < F.col("y.node")))
    share = similarity / (1 + similarity)
    most = F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at"))  # shingles from here on
    fits = (F.col("x.size") >= similarity * F.col("y.size") - 1e-6) & (most >= share * (F.col("x.size") + F.col("y.size")) - 1e-6)
    met = x.join(y, [F.col("x.shingle") == F.col("y.shingle"), F.col("x.part") == F.col("y.part"), F.col("x.c") != F.col("y.c"), smaller, fits])
    return met.select(F.col("x.node").alias("node"), F.col("y.node").alias("leader")).distinct()


def open_groups(sits: DataFrame) -> DataFrame:
    """shingle and size n of the groups of ``sits`` that hold more than one component and an indexed node."""
    mark = F.xxhash64("c")
    groups = sits.groupBy("shingle").agg(F.min(mark).alias("c0"), F.max(mark).alias("c1"), F.count("*").alias("n"), F.max(F.col("at") < F.col("indexed")).alias("any"))
    return groups.where("c0 < c1 and any").select("shingle", "n")


def joined(links: DataFrame, open_: DataFrame) -> DataFrame:
    """Links of nodes as links of their components, a and b."""
    c = open_.select("node", "c")
    return links.select("node", "leader").join(c.withColumnRenamed("c", "a"), "node").join(c.select(F.col("node").alias("leader"), F.col("c").alias("b")), "leader").select("a", "b")


def renamed(df: DataFrame, column: str, found: DataFrame | None) -> DataFrame:
    """``column`` (a component) by what it has become in ``found``."""
    if found is None:
        return df
    return df.join(found.select(F.col("node").alias(column), "component"), column, "left").withColumn(column, F.coalesce("component", column)).drop("component")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, row key, node, class_key, class_id (the least doc_id of the class) and n_links of every row of ``docs``.

    n_links counts the node's links among the pairs that were looked at and verified; those that would only join what is joined already are not looked at.
    """
    store = Store(docs.sparkSession, "neardup")
    rows = store.keep(signed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(text, doc_id).alias("rk"), F.col(text).alias("text")), "text"))
    # From here on a node goes by a number, which is half as wide as its key in all that is shuffled.
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("rk").alias("rk"), F.first("bands").alias("bands"))
    nodes = store.keep(nodes.withColumnRenamed("node", "key").withColumn("node", F.monotonically_increasing_id()))
    listed = nodes.select("node", F.posexplode("bands").alias("band", "at")).select("node", F.xxhash64("band", "at").alias("bucket"))
    members = store.keep(listed.join(listed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket"))
    # How often a node meets others: the most central of a group of copies leads it.
    weight = store.keep(members.groupBy("node").agg(F.sum("n").alias("weight")))
    leaders = members.join(weight, "node").groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("leader"))
    pairs = store.keep(members.join(leaders, "bucket").where("node != leader").select("node", "leader").distinct())
    # Texts of the nodes that are in a bucket, one for each.
    wanted = weight.select("node").join(nodes.select("node", "rk"), "node")
    texts = store.keep(docs.select(row_key(text, doc_id).alias("rk"), F.col(text).alias("text")).join(wanted, "rk").dropDuplicates(["rk"]).select("node", "text"))
    links = [compared(pairs, texts, store, similarity)]
    found = [components(links[0].select(F.col("node").alias("a"), F.col("leader").alias("b")), store)]
    # Nodes of buckets with more than one component, and all that can link them.
    c = F.coalesce("component", "node").alias("c")
    placed = store.keep(members.join(found[0], "node", "left").select("bucket", "node", c))
    mixed = placed.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("bucket")
    open_ = store.keep(placed.join(mixed, "bucket").select("node", "c").distinct().join(weight, "node"))
    store.drop(members, pairs, placed, weight)
    if not open_.isEmpty():
        own = store.keep(texts.join(open_, "node"))
        level = rarity(own)
        prefix = store.keep(map_texts(own, lambda t: prefixes(t, level, similarity), "size long, indexed long, shingles array<long>"))
        sits = prefix.select("node", "c", "weight", "size", "indexed", F.posexplode("shingles").alias("at", "shingle"))
        sits = store.keep(sits.join(open_groups(sits), "shingle"))
        large = sits.where(F.col("n") > FEW)
        lead = large.groupBy("shingle").agg(F.max_by(F.struct(F.col("node").alias("leader"), F.col("c").alias("lc"), F.col("size").alias("ls")), F.struct("weight", "node")).alias("l")).select("shingle", "l.*")
        fits = F.least("size", "ls") >= similarity * F.greatest("size", "ls") - 1e-6
        led = large.join(lead, "shingle").where(F.col("c") != F.col("lc")).where(fits).select("node", "leader").distinct()
        pairs = store.keep(meeting(sits.where(F.col("n") <= FEW), similarity).unionByName(led).distinct())
        links.append(compared(pairs, texts, store, similarity))
        found.append(components(joined(links[1], open_), store))
        left = store.keep(renamed(large.drop("n", "weight"), "c", found[1]))
        pairs = store.keep(meeting(left.join(open_groups(left), "shingle"), similarity))
        links.append(compared(pairs, texts, store, similarity))
        found.append(components(joined(links[2], renamed(open_, "c", found[1])), store))
        store.drop(own, prefix, sits, left)
    named = nodes.select("node", "key", "doc_id", F.col("node").alias("class_key"))
    for f in found:
        named = renamed(named, "class_key", f)
    ends = [x.select(F.col(e).alias("node")) for x in links for e in ("node", "leader")]
    counts = reduce(DataFrame.unionByName, ends).groupBy("node").agg(F.count("*").alias("n_links"))
    named = store.keep(named.join(counts, "node", "left"))
    classes = named.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.min("key").alias("class"))
    named = store.keep(named.join(classes, "class_key").select(F.col("key").alias("node"), F.col("class").alias("class_key"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    store.drop(texts, nodes, *found, *links)
    return rows.select("doc_id", "rk", "node").join(named, "node")


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", F.lower(F.hex("class_key")).alias("class_key"), "n_links")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: that of the least id (a null one last), ties by text, then by the other columns as JSON."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rk")
    kept = near_duplicates(docs).groupBy("class_key").agg(F.min(order).alias("first")).select(F.col("first.rk").alias("__rk"))
    rows = packed(docs, row_key().alias("__rk"))
    others = F.to_json(F.struct(*[F.col(f"__row.`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]))
    first = rows.join(kept, "__rk", "left_semi").groupBy("__rk").agg(F.min_by("__row", others).alias("__row"))
    return first.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is one stream of words, its documents in an order drawn by hash.
The stream is cut into blocks of equal word counts, and a source's target is an
exact quota of blocks. Quotas of all sources are split together down a binary
tree over the output shards: at each node the left half's share of every source
is one multivariate-hypergeometric draw, so counts are exact at every level. A
shard then owns a run of each source's permuted blocks; runs are disjoint, and a
second pass over a source begins only when its first is used up. The last block
drawn from a source is cut so that its words meet the target exactly.

Cases: a null text has size 0 and is never taken; null is a source of its own,
last in order; rows with equal id and text are two documents, of one source or of
several; a source without words has target 0; an empty table gives an empty mix. The order depends on ids
and texts alone, so reruns agree. Rows with equal id, text and source stand one after
another in the stream, those of one partition of ``docs`` as a unit: of such rows, which differ in other columns at
most, the partitions that Spark reads decide the order. Read again, ``docs`` must have the same rows in the same partitions, as files do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, row_key

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block: a source's words over 1024, within these bounds.
BLOCK_WORDS = (64, 4096)
#: Numbers that the plan of a mix may hold, one for each source and shard: very many sources make fewer shards.
PLAN_MOST = 1 << 23
#: Words of a shard, from which the number of shards follows, and fewest shards; rows of a bucket of a source's stream, and fewest buckets.
SHARD_WORDS, SHARDS, BUCKET_ROWS, BUCKETS = 1 << 23, 64, 2048, 256


def word_count(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r; 0 for null."""
    bare = F.trim(F.regexp_replace(text, r"[\x09-\x0D]", " "))
    return F.when(F.length(bare) > 0, F.size(F.array_remove(F.split(bare, " "), ""))).otherwise(0).cast("long")


def unit_key(source: str, text: str, doc_id: str) -> tuple[Column, Column, Column]:
    """rk, key and part: what tells a row by id and text, and by source as well, and the partition that it is read in."""
    own, name = row_key(text, doc_id), F.col(source).cast("string")
    return own.alias("rk"), F.xxhash64(own, name, name.isNull()).alias("key"), F.spark_partition_id().alias("part")


@dataclass
class Source:
    name: str | None
    size: int
    weight: float = 0.0
    target: float = 0.0
    block: int = 1
    blocks: int = 0
    drawn: int = 0  # blocks of all passes
    cut_words: int = 0  # words left out of the last block drawn
    step: int = 1
    shift: tuple[int, ...] = (0, 0, 0)
    offsets: np.ndarray | None = None  # first position of each shard


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is shared again."""
    out, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        closed = set(full)
        open_ = [i for i in open_ if i not in closed]
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Counts by source and shard: rows add up to the quotas, columns differ by one at most."""
    out = np.zeros((len(quotas), shards), dtype=np.int64)
    total = int(quotas.sum())
    room = [total // shards + (i < total % shards) for i in range(shards)]
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        a, b, here = stack.pop()
        if b - a == 1:
            out[:, a] = here
            continue
        m = (a + b) // 2
        draw, rest, left = sum(room[a:m]), int(here.sum()), np.zeros_like(here)
        for s, n in enumerate(here):  # the marginals of a multivariate-hypergeometric draw, one source after another
            n = int(n)
            rest -= n
            left[s] = rng.hypergeometric(n, rest, draw) if n and rest and draw else min(n, draw)
            draw -= int(left[s])
        stack += [(a, m, left), (m, b, here - left)]
    return out


def make_plan(totals: list[tuple[str | None, int]], weights: tuple[float, ...], ratio: float, most: float, shards: int, seed: int) -> list[Source]:
    plan = [Source(n, int(s or 0)) for n, s in sorted(totals, key=lambda x: (x[0] is None, x[0] or ""))]
    shards = max(1, min(shards, PLAN_MOST // max(1, len(plan))))
    for i, s in enumerate(plan):
        s.weight = weights[i % len(weights)]
    for s, t in zip(plan, targets([s.size for s in plan], [s.weight for s in plan], ratio * sum(s.size for s in plan), most), strict=True):
        s.target = t
        s.block = max(BLOCK_WORDS[0], min(BLOCK_WORDS[1], -(-s.size // 1024)))
        s.blocks = -(-s.size // s.block)
    rng = np.random.default_rng(seed)
    for s in plan:
        if not s.blocks:
            continue
        s.step = int(rng.integers(1, max(2, s.blocks)))
        while math.gcd(s.step, s.blocks) != 1:
            s.step += 1
        s.shift = tuple(int(x) for x in rng.integers(0, s.blocks, math.ceil(most) + 1))
        want, short = min(round(s.target), math.floor(most * s.size)), s.blocks * s.block - s.size
        passes, rest = divmod(want, s.size)
        s.drawn = passes * s.blocks
        if rest:
            # The short last block of the stream stands at this position of the pass.
            at = (s.step * (s.blocks - 1) + s.shift[passes]) % s.blocks
            n = -(-rest // s.block)
            got = n * s.block - (short if at < n else 0)
            if got < rest:
                n += 1
                got += s.block - (short if at == n - 1 else 0)
            s.drawn += n
            s.cut_words = got - rest
    counts = split_tree(np.array([s.drawn for s in plan], dtype=np.int64), shards, rng)
    for s, c in zip(plan, counts, strict=True):
        s.offsets = np.cumsum(c) - c
    return plan


def pieces(plan: list[Source], sid: np.ndarray, offset: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """The runs of words that the mix takes: row, first and last word within it, pass, shard, and place in its source's run of the shard."""
    rows, block, lo, hi, owner = [], [], [], [], []
    used = np.flatnonzero(size > 0)
    used = used[np.argsort(sid[used], kind="stable")]
    for at in np.split(used, np.flatnonzero(np.diff(sid[used])) + 1) if len(used) else ():
        s = int(sid[at[0]])
        x = plan[s]
        first, last = offset[at] // x.block, (offset[at] + size[at] - 1) // x.block
        n = last - first + 1
        row = np.repeat(at, n)
        b = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append(row), block.append(b), owner.append(np.full(len(b), s))
        lo.append(np.maximum(b * x.block, offset[row])), hi.append(np.minimum((b + 1) * x.block, offset[row] + size[row]))
    out: dict[str, list] = {k: [] for k in ("row", "start", "end", "turn", "shard", "slot")}
    for row, b, a, z, s in zip(rows, block, lo, hi, owner, strict=True):
        if not len(row):
            continue
        x = plan[s[0]]
        for turn in range(len(x.shift)):
            place = (x.step * b + x.shift[turn]) % x.blocks + turn * x.blocks
            use = place < x.drawn
            end = z
            if x.cut_words:  # the last block drawn ends early
                stop = np.minimum((b + 1) * x.block, x.size) - x.cut_words
                end = np.where(place == x.drawn - 1, np.minimum(z, stop), z)
                use &= end > a
            if not use.any():
                continue
            r = row[use]
            shard = np.searchsorted(x.offsets, place[use], side="right") - 1
            out["row"].append(r), out["start"].append(a[use] - offset[r]), out["end"].append(end[use] - offset[r])
            out["turn"].append(np.full(len(r), turn)), out["shard"].append(shard), out["slot"].append(place[use] - x.offsets[shard])
    return {k: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for k, v in out.items()}


class Mix:
    """A mix of ``docs``: its plan by source and where every document stands in its source's stream.

    ``weights`` go to sources in code-point order, repeating; ``ratio`` is the mix's
    size over the input's; no target is above ``most`` times its source. ``shards``
    follows from the words unless it is given. Sources are collected (one row each), as
    are the counts by source and shard, whose number is bounded; documents are not.
    """

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), ratio: float = 1.5, most: float = 2.0, shards: int | None = None, seed: int = 7, source: str = "source", text: str = "text", doc_id: str = "doc_id"):
        spark = docs.sparkSession
        self.docs = docs
        # A unit: rows of one partition with equal id, text and source. However often a row repeats, no group holds more than a partition.
        units = docs.select(*unit_key(source, text, doc_id), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
        sized = cut(units.groupBy("key", "part").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("rk", "doc_id", "source", "size")]))
        found = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
        if shards is None:
            shards = max(SHARDS, math.ceil(ratio * sum(r["size"] or 0 for r in found) / SHARD_WORDS))
        self.plan = make_plan([(r["source"], r["size"]) for r in found], weights, ratio, most, shards, seed)
        self.seed, self.source, self.text, self.doc_id = seed, source, text, doc_id
        rows = [(s.name, i, s.size, s.target) for i, s in enumerate(self.plan)]
        known = spark.createDataFrame(rows, "name string, sid int, source_size long, target double")
        bits = math.ceil(math.log2(max(BUCKETS, sum(r["n"] for r in found) / BUCKET_ROWS)))
        drawn = sized.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("h", F.xxhash64(F.lit(seed), "rk")).withColumn("bucket", F.shiftrightunsigned("h", 64 - bits).cast("long"))
        # Sums run on in two levels, so that no task has all buckets of a source.
        top = F.shiftright("bucket", bits // 2)
        running = lambda c, over: F.coalesce(F.sum(c).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sums = drawn.groupBy("sid", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words")).withColumn("top", top)
        tops = sums.groupBy("sid", "top").agg(F.sum("words").alias("words"))
        tops = tops.select("sid", "top", running("words", Window.partitionBy("sid").orderBy("top")).alias("top_base"))
        sums = sums.select("sid", "top", "bucket", running("words", Window.partitionBy("sid", "top").orderBy("bucket")).alias("base")).join(tops, ["sid", "top"])
        sums = sums.select("sid", "bucket", (F.col("base") + F.col("top_base")).alias("base"))
        within = running(F.col("size") * F.col("n"), Window.partitionBy("sid", "bucket").orderBy("h", "rk", "part"))
        self.placed = drawn.withColumn("within", within).join(sums, ["sid", "bucket"]).withColumn("offset", F.col("base") + F.col("within")).drop("base", "within", "bucket", "h")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target and the words taken of every document."""
        plan = self.plan

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sid, offset, size = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3))
                p = pieces(plan, sid, offset, size)
                taken = np.bincount(p["row"], weights=p["end"] - p["start"], minlength=len(sid)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(4), b.column(5), pa.array(taken)], names=["doc_id", "size", "source_size", "target", "taken"])

        each = self.placed.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1))).withColumn("offset", F.col("offset") + F.col("i") * F.col("size"))
        return each.select(F.col("doc_id").cast("long"), "sid", "offset", "size", "source_size", "target").mapInArrow(count, "doc_id long, size long, source_size long, target double, taken long")

    def rows(self) -> DataFrame:
        """The mix itself: every piece of text with its shard and its place there, each shard in one partition, shuffled within.

        Columns of the documents stay, ``text`` being the piece; shard, position, turn,
        start and end (words of the document) are added, over columns of these names.
        """
        import re

        plan, text, seed = self.plan, self.text, self.seed
        added = ["shard", "position", "turn", "start", "end"]
        kept = [c for c in self.docs.columns if c not in (*added, text)]
        # Other columns travel as one struct, so that none can clash.
        rest = F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(None).alias("none")]).alias("__kept")
        number, part = unit_key(self.source, text, self.doc_id)[1:]
        body = self.docs.select(rest, F.col(text).alias("__text"), number.alias("__key"), part.alias("__part"), F.monotonically_increasing_id().alias("__at"))
        where = self.placed.where("size > 0").select(F.col("key").alias("__key"), F.col("part").alias("__part"), "sid", "size", "offset")
        # The window has the join's keys, so texts are dealt once.
        nth = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__at")) - 1
        body = body.join(where, ["__key", "__part"]).withColumn("__n", nth)
        body = body.select("__kept", "__text", "sid", "size", (F.col("offset") + F.col("__n") * F.col("size")).alias("offset"))
        fields = f"__kept {body.schema['__kept'].dataType.simpleString()}, __text string, " + ", ".join(f"`{c}` long" for c in added)

        def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            spans = re.compile(WORD)
            for b in batches:
                get = lambda name: b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
                texts = b.column(1)
                p = pieces(plan, get("sid"), get("offset"), get("size"))
                order = np.argsort(p["row"], kind="stable")
                p = {k: v[order] for k, v in p.items()}
                size, cut_text, last, at = get("size"), [], -1, []
                for r, a, z in zip(p["row"].tolist(), p["start"].tolist(), p["end"].tolist(), strict=True):
                    if a == 0 and z == size[r]:
                        cut_text.append(texts[r].as_py())
                        continue
                    if r != last:
                        last, whole = r, texts[r].as_py()
                        at = [m.span() for m in spans.finditer(whole)]
                    cut_text.append(whole[at[a][0] : at[z - 1][1]])
                from .codes import mix

                slot = mix(p["slot"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(get("sid")[p["row"]].astype(np.uint64) + np.uint64(seed))) >> np.uint64(1)
                p["position"] = slot.astype(np.int64)
                columns = [b.column(0).take(pa.array(p["row"])), pa.array(cut_text, pa.string())] + [pa.array(p[c]) for c in added]
                yield pa.RecordBatch.from_arrays(columns, names=["__kept", "__text", *added])

        mixed = body.mapInArrow(slices, fields).select(*[F.col(f"__kept.`{c}`").alias(c) for c in kept], F.col("__text").alias(text), *added)
        return mixed.repartition("shard").sortWithinPartitions("shard", "position", "start")


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return Mix(table(spark, sf_dir, "documents")).taken()


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what the earlier stages kept: pieces of documents by shard and position."""
    return Mix(docs).rows()

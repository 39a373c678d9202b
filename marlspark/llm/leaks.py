"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages: windows of 64 words, 32 words apart. Passages and
pieces of benchmark items (cut in the same way) are TF-IDF vectors over the words of the items, whose document
frequencies count all documents; common words weigh little, but none weighs nothing,
since a leak in many documents makes its own words common. A distributed randomised SVD (one pass: every task sums
A'(A W) over its passages, W Gaussian; the driver takes the Nystroem
factorisation of that sum and the items' own share) gives a latent space. Passages
whose cosine to a piece is high enough there are candidates. A candidate is
confirmed on words: the longest common subsequence of the whole item and
the passage with what is around it (as much as the item is long, if that is more than
a passage), and whether the item's answer, its last quarter, is there too. An item that is
nearly whole needs no answer, so paraphrases and exact copies are both found.

Items are handled in blocks of a bounded number of pieces, each over all documents, so what the
driver and the tasks hold (words of a block by rank) is bounded.

Cases: null and empty texts match nothing; items of fewer than five words are not
searched; items with equal id and text count once; a null item_id is kept as such;
rows are judged alone, so repeated rows repeat; either table may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codes import U, word_codes, words
from .common import chunks, map_texts, packed, table, unpacked

HALF = 32
#: Pieces of a block's items and dimensions of its latent space.
BLOCK, RANK = 512, 160
#: Least cosine of a candidate, share of the item that the common subsequence needs with and without the answer, share of the answer.
COSINE, PART, WHOLE, ANSWER = 0.5, 0.6, 0.85, 0.5
LEAST_WORDS = 5


def places(a: list[int]) -> dict[int, int]:
    """Where each word of ``a`` stands, as bits."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    return where


def subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    return common(places(a), len(a), b)


def common(where: dict[int, int], n: int, b: list[int], least: float = 0) -> int:
    """Length of the longest common subsequence of n words at ``where`` and ``b``, by bit-parallel rows; 0 if too few words of ``b`` are there for ``least``."""
    rows = [m for m in map(where.get, b) if m]
    if len(rows) < least:
        return 0
    v = full = (1 << n) - 1
    for m in rows:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


@dataclass
class Hits:
    """Words of a chunk of texts that are in the vocabulary: word, half passage; and each text's half passages."""

    word: np.ndarray
    half: np.ndarray
    code: np.ndarray
    first: np.ndarray  # word at which each text starts
    count: np.ndarray  # words of each text
    halves: np.ndarray  # half passages of each text


def find(texts: list[str], vocabulary: np.ndarray, near: np.ndarray) -> Hits:
    code, doc, count = words(texts)
    first = np.cumsum(count) - count
    maybe = np.flatnonzero(near[(code & U(0xFFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(vocabulary, code[maybe]), len(vocabulary) - 1)
    hit = vocabulary[at] == code[maybe]
    place, word = maybe[hit], at[hit]
    halves = -(-count // HALF)
    base = np.cumsum(halves) - halves
    d = doc[place]
    return Hits(word, base[d] + (place - first[d]) // HALF, code, first, count, halves)


def near_table(vocabulary: np.ndarray) -> np.ndarray:
    near = np.zeros(1 << 20, dtype=bool)
    near[(vocabulary & U(0xFFFFF)).astype(np.int64)] = True
    return near


def windows(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first and last half passage of every passage: two neighbouring halves, or a text's only one."""
    n = np.where(halves > 1, halves - 1, halves)
    base = np.cumsum(halves) - halves
    text = np.repeat(np.arange(len(halves)), n)
    a = base[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, a, np.where(halves[text] > 1, a + 1, a)


def summed(rows: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums of consecutive ``rows`` with equal ``group`` (ascending), by group."""
    out = np.zeros((n, rows.shape[1]), dtype=rows.dtype)
    if len(rows):
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        out[group[start]] = np.add.reduceat(rows, start, axis=0)
    return out


class Frequent:
    """Sums of rows by word, the most frequent words through one dense matrix of counts and the others one by one."""

    def __init__(self, df: np.ndarray, most: int = 256, block: int = 4096):
        self.words = np.sort(np.argsort(-df, kind="stable")[:most])
        self.column = np.full(len(df), -1, np.int64)
        self.column[self.words] = np.arange(len(self.words))
        self.block = block

    def parts(self, word: np.ndarray, group: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """By block of groups (ascending): first and end, counts of the frequent words, words and groups of the others."""
        edge = np.searchsorted(group, np.arange(0, n + self.block, self.block))
        k = len(self.words)
        for b, (x, z) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            a, e = b * self.block, min(n, (b + 1) * self.block)
            w, g = word[x:z], group[x:z] - a
            column = self.column[w]
            often = column >= 0
            counts = np.bincount(g[often] * k + column[often], minlength=(e - a) * k).reshape(e - a, k).astype(np.float32)
            yield a, e, counts, w[~often], g[~often]

    def project(self, rows: np.ndarray, word: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
        """Sums of ``rows`` of the words of each group."""
        out = np.zeros((n, rows.shape[1]), np.float32)
        own = rows[self.words]
        for a, e, counts, w, g in self.parts(word, group, n):
            out[a:e] = counts @ own + summed(rows[w], g, e - a)
        return out

    def back(self, total: np.ndarray, rows: np.ndarray, word: np.ndarray, group: np.ndarray, n: int) -> None:
        """Add to ``total``, for each word, the product of its groups' sums of ``rows``: A'(A rows)."""
        own = rows[self.words]
        for _, _, counts, w, g in self.parts(word, group, n):
            y = counts @ own + summed(rows[w], g, len(counts))
            total[self.words] += counts.T @ y
            order = np.argsort(w, kind="stable")
            some, at = np.unique(w, return_inverse=True)
            total[some] += summed(y[g[order]], at[order], len(some))


@dataclass
class Item:
    item_id: int | None
    codes: list[int]

    def __post_init__(self):
        self.where = places(self.codes)
        answer = self.codes[-max(3, len(self.codes) // 4) :]
        self.answer, self.answer_length = places(answer), len(answer)

    def pieces(self) -> list[list[int]]:
        """The item cut into passages like a document; a short one is one piece."""
        return [self.codes[x : x + 2 * HALF] for x in range(0, max(len(self.codes) - HALF, 1), HALF)]


@dataclass
class Latent:
    vocabulary: np.ndarray  # sorted codes
    basis: np.ndarray  # words by rank, idf included
    frequent: Frequent
    pieces: np.ndarray  # unit vectors by piece
    owner: np.ndarray  # item of each piece


def frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """How many documents each word of the vocabulary is in, and how many there are."""
    near, v = near_table(vocabulary), len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(v + 1, dtype=np.int64)
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for i, j in chunks(texts):
                h = find(texts[i:j], vocabulary, near)
                base = np.cumsum(h.halves)
                doc = np.searchsorted(base, h.half, side="right")
                total[:v] += np.bincount(np.unique(doc * v + h.word) % v, minlength=v)
                total[v] += j - i
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["word", "n"])

    out = np.zeros(v + 1)
    for r in docs.select(F.col(text)).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n")).collect():
        out[r[0]] = r[1]
    return out[:v], int(out[v])


def sketch(docs: DataFrame, text: str, vocabulary: np.ndarray, scaled: np.ndarray, idf: np.ndarray, frequent: Frequent) -> np.ndarray:
    """A'(A W) over all passages (neighbouring halves apart), A being TF-IDF and ``scaled`` idf * W."""
    near, (v, r) = near_table(vocabulary), scaled.shape
    size = 256  # words of a piece of the sum

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((v, r), dtype=np.float32)
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for i, j in chunks(texts):
                h = find(texts[i:j], vocabulary, near)
                frequent.back(total, scaled, h.word, h.half // 2, (int(h.halves.sum()) + 1) // 2)
        total *= idf[:, None]
        pieces = range(0, v, size)
        yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int64()), pa.array([total[p : p + size].tobytes() for p in pieces], pa.binary())], names=["piece", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:  # one piece of a task at a time, whatever their number
            for p, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), np.float32)
                total[p] = total[p] + x if p in total else x.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["piece", "data"])

    spread = docs.select(F.col(text)).mapInArrow(local, "piece long, data binary").repartition(F.col("piece"))
    out = np.zeros((v, r))
    for row in spread.mapInArrow(add, "piece long, data binary").collect():
        x = np.frombuffer(row["data"], np.float64).reshape(-1, r)
        out[row["piece"] : row["piece"] + len(x)] += x
    return out


def fit(docs: DataFrame, items: list[Item], text: str = "text", rank: int = RANK, seed: int = 1) -> Latent:
    vocabulary = np.unique(np.array([c for it in items for c in it.codes], dtype=np.uint64))
    df, n = frequencies(docs, text, vocabulary)
    idf = np.log((n + 1) / (df + 1)) + 1
    v, frequent = len(vocabulary), Frequent(df)
    pieces = [p for it in items for p in it.pieces()]
    owner = np.repeat(np.arange(len(items)), [len(it.pieces()) for it in items])
    if not v:
        return Latent(vocabulary, np.zeros((0, 1), np.float32), frequent, np.zeros((len(pieces), 1), np.float32), owner)
    a = np.zeros((len(pieces), v))  # bounded by a block's pieces and words
    for i, p in enumerate(pieces):
        own_codes = np.array(p, np.uint64)
        at = np.minimum(np.searchsorted(vocabulary, own_codes), v - 1)
        np.add.at(a[i], at[vocabulary[at] == own_codes], 1)
    a *= idf
    r = min(rank, v)
    w = np.random.default_rng(seed).normal(size=(v, r))
    corpus = sketch(docs, text, vocabulary, (idf[:, None] * w).astype(np.float32), idf.astype(np.float32), frequent)
    own = a.T @ (a @ w)
    # Items count as much as the corpus, so that their own words are in the space.
    balance = np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-12)
    total = corpus + max(balance, 1e-6) * own
    # Nystroem: A'A ~ (A'A W)(W'A'A W)^-1 (A'A W)'; the pseudo-inverse's root leaves out noise.
    core = w.T @ total
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > 1e-9 * max(value.max(), 1e-300)
    half = total @ (vector[:, good] / np.sqrt(value[good])) if good.any() else np.zeros((v, 1))
    u = np.linalg.svd(half, full_matrices=False)[0]
    q = a @ u
    q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
    return Latent(vocabulary, (idf[:, None] * u).astype(np.float32), frequent, q.astype(np.float32), owner)


def matches(texts: list[str], items: list[Item], latent: Latent, near: np.ndarray, cosine: float = COSINE) -> list[dict[int, tuple[float, float, float]]]:
    """Of each text: best (subsequence, answer, cosine) by item confirmed."""
    out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
    h = find(texts, latent.vocabulary, near)
    rows = latent.frequent.project(latent.basis, h.word, h.half, int(h.halves.sum()))
    text, a, z = windows(h.halves)
    base = np.cumsum(h.halves) - h.halves
    for x in range(0, len(text), 1 << 13):
        p = rows[a[x : x + (1 << 13)]] + np.where((z > a)[x : x + (1 << 13), None], rows[z[x : x + (1 << 13)]], 0)
        norm = np.sqrt((p * p).sum(axis=1))
        some = np.flatnonzero(norm > 1e-6)
        c = (p[some] / norm[some, None]) @ latent.pieces.T
        who, piece = np.nonzero(c >= cosine)
        near_by: dict[tuple[int, int], float] = {}  # passage and item: best cosine of the item's pieces
        for w, i, s in zip((some[who] + x).tolist(), latent.owner[piece].tolist(), c[who, piece].tolist(), strict=True):
            near_by[w, i] = max(s, near_by.get((w, i), s))
        for (w, i), s in near_by.items():
            t = int(text[w])
            best = out[t].get(i)
            if best and best[0] >= 1.0:
                continue
            it = items[i]
            length = len(it.codes)
            # The passage and, on either side, a quarter of one more or as many words as a longer item has.
            reach = length if length > 2 * HALF else HALF // 2
            lo = max(0, (int(a[w]) - int(base[t])) * HALF - reach)
            hi = min(int(h.count[t]), (int(z[w]) - int(base[t]) + 1) * HALF + reach)
            codes = h.code[h.first[t] + lo : h.first[t] + hi].tolist()
            share = common(it.where, length, codes, PART * length) / length
            if share < PART:
                continue
            answer = common(it.answer, it.answer_length, codes) / it.answer_length
            if (share >= WHOLE or answer >= ANSWER) and (not best or share > best[0]):
                out[t][i] = (share, answer, s)
    return out


def benchmark_blocks(benchmark: DataFrame, text: str, item_id: str, block: int) -> Iterator[list[Item]]:
    """The benchmark's items, a bounded block at a time."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).distinct()
    rows = rows.orderBy("i", "t")
    part: list[Item] = []
    size = 0
    for r in rows.toLocalIterator():
        codes = word_codes(r["t"]).tolist()
        if len(codes) >= LEAST_WORDS:
            part.append(Item(r["i"], codes))
            size += len(part[-1].pieces())
        if size >= block:  # a longer item may end beyond it
            yield part
            part, size = [], 0
    if part:
        yield part


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", block: int = BLOCK, rank: int = RANK, keep: bool = False) -> DataFrame:
    """Replace ``text`` by leaks: array of item_id, share (of the item in the common subsequence), answer and cosine; with ``keep`` the text stays.

    Each block of items is one more pass over the documents, and its column is
    appended to the leaks of the blocks before it.
    """
    kind = "array<struct<item_id: long, share: double, answer: double, cosine: double>>"
    kept = [c for c in docs.columns if c not in (text, "leaks")]
    found = docs.select(*kept, F.col(text)).withColumn("leaks", F.array().cast(kind))
    for items in benchmark_blocks(benchmark, "text", item_id, block):
        latent = fit(docs, items, text, rank)
        if not len(latent.vocabulary):
            continue
        near = near_table(latent.vocabulary)

        def look(texts: list[str], items=items, latent=latent, near=near) -> dict[str, list]:
            rows = matches(texts, items, latent, near)
            return {"__more": [[{"item_id": items[i].item_id, "share": s, "answer": b, "cosine": c} for i, (s, b, c) in sorted(r.items())] for r in rows]}

        found = map_texts(found, look, f"__more {kind}", text, keep=True)
        found = found.withColumn("leaks", F.concat("leaks", "__more")).drop("__more")
    return found if keep else found.drop(text)


def op4_find_leaks(spark, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.share", "leak.answer", "leak.cosine")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    found = find_leaks(packed(docs, F.col("text").alias("__text"), out="text"), table(spark, sf_dir, "benchmark"), "__text", keep=True)
    return unpacked(found.where(F.size("leaks") == 0), docs.columns)

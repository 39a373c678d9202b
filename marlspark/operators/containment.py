"""Which texts hold which others, by ranked postings of grams.

A text's grams are hashes of its runs of ``GRAM`` bytes, sampled by windows: of every
``WINDOW`` runs in a row the least hash. A window of a text is one of any text that
holds it, so all grams of the small text are grams of the big one. A big text's
postings are met with the small texts' grams; of those the rarest among the big texts
leads each small text to its candidates, and one that no big text has ends the search.
Texts are then joined to the candidates to be compared; postings hold hashes alone.

Texts too short for a window go by their first 8, 4, 2 or 1 bytes, which are looked for at
every place of the big ones; only the lengths that short texts ask for are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.shared import kept

#: Bytes of a gram, grams of a window, lengths of a short text's start, and bytes that are worked on at a time.
GRAM, WINDOW, STARTS, CHUNK = 12, 16, (8, 4, 2, 1), 1 << 20
NEED = GRAM + WINDOW - 1


def _hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` bytes."""
    n = len(data) - k + 1
    h = np.full(max(n, 0), k, dtype=np.uint64)
    for j in range(k if n > 0 else 0):
        h = h * np.uint64(0x100000001B3) + data[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` in a row; ``w`` is a power of two."""
    step = 1
    while step < w:
        h = np.minimum(h[:-step], h[step:]) if len(h) > step else h[:0]
        step *= 2
    return h


def _pieces(texts: list[bytes], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of whole texts, about CHUNK at a time, and the row of each byte; longer texts in overlapping slices."""
    held, rows, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - overlap), CHUNK):
            part = t[at : at + CHUNK + overlap]
            if size and size + len(part) > CHUNK:
                yield np.frombuffer(b"".join(held), np.uint8), np.concatenate(rows)
                held, rows, size = [], [], 0
            held.append(part), rows.append(np.full(len(part), i, dtype=np.int64))
            size += len(part)
    if size:
        yield np.frombuffer(b"".join(held), np.uint8), np.concatenate(rows)


class Form(NamedTuple):
    """How texts are compared: ``column`` makes the text that must be contained, ``rough`` bytes for finding candidates.

    If one text's ``column`` contains another's, its ``rough`` must contain the other's. ``bare`` tells that
    ``rough`` may be empty where ``column`` is not.
    """

    column: Callable[[Column], Column]
    rough: Callable[[str], bytes]
    bare: bool = False


_NO_KEY = bytes(c for c in range(256) if not (48 <= c < 58 or 97 <= c < 123))


def _rough_squeezed(t: str) -> bytes:
    return t.lower().encode().translate(None, _NO_KEY)


def _rough_normal(t: str) -> bytes:
    """What normalisation leaves alone: no white space, hyphens or quotes, ligatures spelled out."""
    t = t.lower()
    if not t.isascii():
        for one, spelled in (*X.LIGATURES, *((q, "") for q in X.QUOTES[0]), ("ς", "σ")):
            t = t.replace(one, spelled)
    return "".join(t.split()).encode().translate(None, b"-\"'")


PLAIN = Form(lambda c: c, str.encode)
SQUEEZED = Form(X.squeezed, _rough_squeezed)
NORMAL = Form(lambda c: F.lower(X.normalized_text(c)), _rough_normal, True)


def _sampled(data: list[bytes], starts: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """row and gram, distinct within a piece: the least of every window, and every run of the lengths ``starts``."""
    for buffer, row in _pieces(data, NEED - 1):
        for k, w in ((GRAM, WINDOW), *((s, 1) for s in starts)):
            h, span = _least(_hashes(buffer, k), w), k + w - 1
            if not len(h):
                continue
            own = row[: len(h)]
            inside = own == row[span - 1 : span - 1 + len(h)]  # not over the edge of two texts
            inside[1:] &= (h[1:] != h[:-1]) | (own[1:] != own[:-1]) | ~inside[:-1]
            own, h = own[inside], h[inside]
            order = np.lexsort((h, own))
            own, h = own[order], h[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
            yield own[new], h[new].view(np.int64)


def postings(texts: DataFrame, rough: Callable[[str], bytes], starts: Sequence[int] = ()) -> DataFrame:
    """a, b and gram of big texts (a, b, t): sampled grams, and every run of the lengths ``starts``; 0 stands for one gram of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            if 0 in starts:
                yield pa.RecordBatch.from_arrays([a, b, pa.array(np.zeros(len(a), np.int64))], names=["a", "b", "gram"])
            for row, gram in _sampled([rough(t) for t in batch.column(2).to_pylist()], [x for x in starts if x]):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([a.take(at), b.take(at), pa.array(gram)], names=["a", "b", "gram"])

    return texts.select("a", "b", "t").mapInArrow(run, "a long, b long, gram long")


def wanted(texts: DataFrame, form: Form, most: int | None = None) -> DataFrame:
    """a, b, start and gram of small texts: their sampled grams (start -1), or their start where they are too short; none of those over ``most`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            data = [form.rough(t) for t in batch.column(2).to_pylist()]
            short = []
            for i, t in enumerate(data):
                if len(t) < NEED and (t or form.bare) and (most is None or len(t) <= most):
                    s = next((s for s in STARTS if s <= len(t)), 0)
                    short.append((i, s, int(_hashes(np.frombuffer(t[:s], np.uint8), s).view(np.int64)[0]) if s else 0))
            long = [t if NEED <= len(t) and (most is None or len(t) <= most) else b"" for t in data]
            rows = [(r, np.full(len(r), -1), g) for r, g in _sampled(long)]
            if short:
                rows.append(tuple(np.array(z, dtype=np.int64) for z in zip(*short, strict=True)))
            for r, s, g in rows:
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays([a.take(at), b.take(at), pa.array(s), pa.array(g)], names=["a", "b", "start", "gram"])

    return texts.select("a", "b", "t").mapInArrow(run, "a long, b long, start long, gram long")


def longest(texts: DataFrame, rough: Callable[[str], bytes]) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([max((len(rough(t)) for t in b.column(0).to_pylist()), default=0)], pa.int64())], names=["n"])

    return texts.select("t").mapInArrow(run, "n long").agg(F.max("n")).first()[0] or 0


def candidates(small: DataFrame, big: DataFrame, form: Form, bounded: bool) -> DataFrame:
    """sa, sb, ba, bb: texts of ``small`` (a, b, t) and those of ``big`` that have the rarest of their grams; distinct."""
    own = kept(wanted(small, form, longest(big, form.rough) if bounded else None), "wanted")
    starts = sorted(r[0] for r in own.where("start >= 0").select("start").distinct().collect())  # five at most
    hits = postings(big, form.rough, starts).join(own.select("gram").distinct(), "gram", "left_semi")
    hits = kept(hits.select(F.col("a").alias("ba"), F.col("b").alias("bb"), "gram"), "hits")
    frequency = hits.groupBy("gram").agg(F.count("*").alias("n"))
    ranked = own.join(frequency, "gram", "left").groupBy(F.col("a").alias("sa"), F.col("b").alias("sb"))
    probes = ranked.agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.max(F.col("n").isNull()).alias("lacks")).where("not lacks").drop("lacks")
    return probes.join(hits, "gram").drop("gram").distinct()


def containing(small: DataFrame, big: DataFrame, small_text: str, big_text: str, form: Form = PLAIN, bounded: bool = False) -> DataFrame:
    """Rows of ``small`` beside those of ``big`` whose text contains theirs, both in ``form``; null and empty texts of ``small`` are in none.

    ``bounded`` leaves out small texts that are longer than all big ones before anything else; for small sides that are mostly longer.
    Texts are told by two hashes of what they are before ``form``, which is made of candidates alone.
    """
    told = lambda df, p, t: df.where(F.col(t).isNotNull()).withColumns({f"__{p}a": F.xxhash64(t), f"__{p}b": F.crc32(F.col(t).cast("binary"))})
    own, held = told(small, "s", small_text), told(big, "b", big_text)
    texts = lambda df, p, t: df.select(F.col(f"__{p}a").alias("a"), F.col(f"__{p}b").alias("b"), F.col(t).alias("t"))
    found = kept(candidates(texts(own, "s", small_text), texts(held, "b", big_text), form, bounded), "candidates")
    met = own.join(found, (F.col("__sa") == F.col("sa")) & (F.col("__sb") == F.col("sb")))
    met = met.join(held, (F.col("ba") == F.col("__ba")) & (F.col("bb") == F.col("__bb")))
    x, y = form.column(F.col(small_text)), form.column(F.col(big_text))
    # One condition of both sides, so that no form is made below the joins.
    return met.where(F.contains(y, F.nullif(x, F.lit("")))).select(*small.columns, *big.columns)


def contained_first(left: DataFrame, right: DataFrame, left_key: str, left_text: str, right_order: str, right_text: str, take: Sequence[str], least: int = 1) -> DataFrame:
    """The first row of ``right`` whose squeezed text contains, or is contained in, that of each row of ``left``.

    Rows of ``right`` with equal squeezed texts are one: in the first one's place, with the last one's values. An empty
    text is in all; texts squeezed to fewer than ``least`` characters match nothing.
    """
    a = left.select(F.col(left_key).alias("__k"), F.col(left_text).alias("__a"))
    b = right.select(F.col(right_order).alias("__o"), F.col(right_text).alias("__b"), F.struct(*take).alias("__v"))
    key = lambda c: F.coalesce(X.squeezed(F.col(c)), F.lit(""))
    fold = [F.min("__o").alias("__o"), F.max_by("__v", "__o").alias("__v")]
    pairs = containing(a, b, "__a", "__b", SQUEEZED).unionByName(containing(b, a, "__b", "__a", SQUEEZED, bounded=True))
    if least > 1:
        pairs = pairs.where(F.least(F.length(key("__a")), F.length(key("__b"))) >= least)
    pairs = pairs.select("__k", "__o", "__v", key("__b").alias("__y"))
    first = pairs.groupBy("__k", F.xxhash64("__y").alias("__h"), F.length("__y").alias("__n")).agg(*fold).drop("__h", "__n")
    if least < 1:
        empty = b.where(key("__b") == "").agg(*fold).where("__o is not null")  # one row: it is in every text of the left
        held = b.withColumn("__h", F.xxhash64(key("__b"))).groupBy("__h").agg(*fold).orderBy("__o").limit(1).select("__o", "__v")  # one row: it holds every empty text
        first = first.unionByName(a.select("__k").crossJoin(F.broadcast(empty))).unionByName(a.where(key("__a") == "").select("__k").crossJoin(F.broadcast(held)))
    best = first.groupBy("__k").agg(F.min_by("__v", "__o").alias("__v"))
    return left.join(best, left[left_key] == F.col("__k"), "left").select(*left.columns, *[F.col(f"__v.{c}").alias(f"matched_{c}") for c in take])

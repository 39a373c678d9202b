"""Language identification by the nearest of several centroids per language.

A text is a vector of its hashed byte 2- and 3-grams over letters (all other
ASCII is a space), weighted log(1 + tf) * idf and normalised. Document frequencies
come from all labelled rows; the centroids of a language are a spherical k-means of
a bounded sample of its rows. A text goes to the language of the nearest centroid
by cosine; it is rejected where it has no letter or its cosine is under a fixed
fraction of the lowest 1% of that language's sampled texts; for a text of less than
64 letters that falls with the root of their number, as cosines of few grams do.

Cases: null texts, empty ones and those without letters are ``und``, score 0,
rejected; rows without a language are predicted but never learned from; without
any labelled row all are ``und``; ties go to the language first in order;
repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .codes import IS_LETTER, encode
from .common import chunks, fold, map_texts, packed, table, unpacked

BITS = 12
D = 1 << BITS
UNDETERMINED = "und"
#: Quantile of the sampled texts' cosines that the bound of a language starts from.
LOW = 0.01
#: A text with fewer letters has a lower bound.
LETTERS = 64
#: Texts whose dense vectors are held at a time, and languages that are learned at most, the most frequent.
TEXTS, LANGUAGES = 256, 1000
_LETTERS = np.where(IS_LETTER, np.arange(256), 32).astype(np.uint8)


def counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed 2- and 3-grams by text."""
    data, starts = encode(texts)
    x = _LETTERS[data].astype(np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64) * D, np.diff(starts))
    # Every text ends in a space; no gram begins there or goes beyond, so that a text's neighbours don't matter.
    inside = np.ones(max(len(x) - 1, 0), dtype=bool)
    ends = starts[1:] - 1
    inside[ends[ends < len(inside)]] = False
    two = x[:-1] * np.uint32(0x9E3779B1) ^ x[1:] * np.uint32(0x85EBCA77)
    out = np.bincount((row[:-1] + ((two * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)))[inside], minlength=len(texts) * D)
    if len(x) > 2:
        three = (two[:-1] * np.uint32(0x27D4EB2F)) ^ (x[2:] * np.uint32(0x165667B1))
        out += np.bincount((row[:-2] + ((three * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)))[inside[:-1] & inside[1:]], minlength=len(texts) * D)
    return out.reshape(len(texts), D)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts(texts).astype(np.float32)) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def spherical_kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k unit centroids; the first is that of all, further ones start at the rows that are farthest off."""
    unit = lambda c: c / max(np.linalg.norm(c), 1e-12)
    centres = [unit(v.mean(axis=0))]
    while len(centres) < min(k, len(v)):
        centres.append(v[np.argmin((v @ np.array(centres).T).max(axis=1))])
    c = np.array(centres)
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.array([unit(v[own == i].mean(axis=0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    farthest: np.ndarray  # largest accepted distance, by centroid's language
    idf: np.ndarray


def fit(docs: DataFrame, known: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = 600, clusters: int = 3, fraction: float = 0.6) -> Model:
    """Learn from rows where ``known`` holds and the language is not null.

    About ``sample`` rows of each of the ``LANGUAGES`` most frequent languages, those of
    least hash, make its centroids, rows with equal id and text as one; idf counts all learned rows.
    A document of a language that is not learned, be it beyond ``LANGUAGES``, is judged by distance: rejected, or taken for the nearest.
    """
    rows = docs.where(known & F.col(lang).isNotNull())
    code = F.xxhash64(F.lit(5), doc_id, text)
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang).alias("l")).agg(F.approx_count_distinct(code).alias("n"), F.count("*").alias("rows")).orderBy(F.desc("rows"), "l").limit(LANGUAGES).collect()}
    if not sizes:
        return Model([], np.zeros((0, D), np.float32), np.zeros(0), np.ones(D, np.float32))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(D + 1, dtype=np.int64), 0
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for i, j in chunks(texts, count=TEXTS):
                total[:D] += (counts(texts[i:j]) > 0).sum(axis=0)
                n += j - i
        total[D] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(D + 1)), pa.array(total)], names=["term", "n"])

    df = np.zeros(D + 1)
    for r in rows.select(F.col(text)).mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    idf = (np.log((1 + df[D]) / (1 + df[:D])) + 0.1).astype(np.float32)

    # One number for each language goes into the plan, so that texts aren't dealt out for a join.
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))]), F.col("lang"))
    drawn = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), code.alias("h"))
    # Equal rows are drawn as one, so that however many there are the groups stay near ``sample``.
    # 53 bits of the hash are a number from 0 to 1, so that the share may be as small as the rows are many.
    place = F.pmod("h", F.lit(1 << 20)) * float(1 << 33) + F.shiftrightunsigned("h", 31)
    drawn = drawn.where(place / float(1 << 53) < share).dropDuplicates(["lang", "h"]).select("lang", "text")

    def cluster(key: tuple[str], rows: pd.DataFrame) -> pd.DataFrame:
        v = np.concatenate([vectors([t or "" for t in rows["text"].iloc[i : i + 50]], idf) for i in range(0, len(rows), 50)])
        v = v[(v != 0).any(axis=1)]
        if not len(v):
            return pd.DataFrame({"lang": [], "centroid": [], "farthest": []})
        c = spherical_kmeans(v, clusters)
        # A low quantile, for a few outliers among the sampled texts must not set the bound.
        far = 1 - float(np.quantile((v @ c.T).max(axis=1), LOW))
        return pd.DataFrame({"lang": key[0], "centroid": [x.astype(np.float32) for x in c], "farthest": far})

    found = sorted(drawn.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, farthest double").collect(), key=lambda r: r["lang"])
    return Model([r["lang"] for r in found], np.array([r["centroid"] for r in found], np.float32).reshape(-1, D), 1 - fraction * (1 - np.array([r["farthest"] for r in found])), idf)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: bool = False) -> DataFrame:
    """Replace ``text`` by lang_pred, score (cosine to the nearest centroid) and whether it is rejected; with ``keep`` the text stays beside them."""

    def nearest(texts: list[str]) -> dict[str, list]:
        if not model.languages:
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts), "rejected": [True] * len(texts)}
        cosine = vectors(texts, model.idf) @ model.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(np.float64)
        letters = [any(map(str.isalpha, t)) for t in texts]
        return {
            "lang_pred": [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)],
            "score": [float(s) if ok else 0.0 for s, ok in zip(score, letters, strict=True)],
            "rejected": [not ok or bool(s < (least := 1 - model.farthest[b]) and s < least * min(1.0, sum(map(str.isalpha, t)) / LETTERS) ** 0.5) for t, s, b, ok in zip(texts, score, best, letters, strict=True)],
        }

    return map_texts(docs, nearest, "lang_pred string, score double, rejected boolean", text, TEXTS, keep)


def op1_identify_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, fold("doc_id", 3) != 1)
    return predict(docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"), model)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that the classifier rejects go.

    Each row carries its own decision, so nothing is joined.
    """
    model = fit(docs, fold("doc_id", 3) != 1)
    return unpacked(predict(packed(docs, F.col("text").alias("__text"), out="text"), model, "__text", True).where("not rejected"), docs.columns)

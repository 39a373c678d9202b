"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

Voters. From a bounded sample of labelled rows, words (lexicon voters) and words'
first four or five bytes (pattern voters) that occur nearly only in toxic documents,
by a G-test and by share, vote toxic where they occur; three further voters vote on
how many lexicon and pattern voters fire, and clean where none does.

Label model. Expectation maximisation estimates each voter's rates of firing in
either class without looking at labels again; correlations between voters,
measured within the sample, discount the votes of those that repeat each other.
The class balance is the sample's.

Classifier. A logistic regression over the most informative words and patterns is
trained on the label model's posteriors and scores every document.

Cases: null and empty texts get the score of a text without any feature; without
labelled rows, or with one class alone, the score is the sample's balance (0.0
where there is none); label rows that repeat a document count once, as toxic if
any says so; rows are scored alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .codes import IS_WORD, U, encode, hash_spans, mix, spans
from .common import fold, map_texts, table


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature codes of each text and the text of each: words, and first 4 and 5 bytes of longer words."""
    data, starts = encode(texts)
    a, z = spans(IS_WORD[data])
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.searchsorted(starts, a, side="right") - 1
    codes, owners = [hash_spans(data, a, z)], [doc]
    for n, salt in ((4, 0x51ED27), (5, 0xA0761D)):
        long = z - a > n
        codes.append(mix(hash_spans(data, a[long], a[long] + n) ^ U(salt)))
        owners.append(doc[long])
    code, doc = np.concatenate(codes), np.concatenate(owners)
    return code, doc


def distinct(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((code, doc))
    code, doc = code[order], doc[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    return code[new], doc[new]


@dataclass
class Model:
    codes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float
    accuracies: dict[int, tuple[float, float]]  # of each voter: rate of firing in toxic and in clean documents
    effective: np.ndarray  # share of each voter's vote that is its own


def label_model(votes: np.ndarray, balance: float, start: tuple[np.ndarray, np.ndarray], rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors, rates of firing by class and effective weights of 0/1 ``votes`` (documents by voters)."""
    v = votes.astype(np.float64)
    toxic, clean = start
    posterior = np.full(len(v), balance)
    own = np.ones(v.shape[1])
    for _ in range(rounds):
        toxic, clean = np.clip(toxic, 1e-3, 1 - 1e-3), np.clip(clean, 1e-3, 1 - 1e-3)
        fire, quiet = np.log(toxic / clean) * own, np.log((1 - toxic) / (1 - clean)) * own
        logit = np.log(balance / (1 - balance)) + v @ fire + (1 - v) @ quiet
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        toxic = (posterior @ v + 0.1) / (posterior.sum() + 1)
        clean = ((1 - posterior) @ v + 0.01) / ((1 - posterior).sum() + 1)
        # What two voters share beyond what the classes explain.
        centred = v - np.outer(posterior, toxic) - np.outer(1 - posterior, clean)
        scale = np.sqrt((centred**2).mean(axis=0)) + 1e-9
        correlation = np.clip((centred.T @ centred) / len(v) / np.outer(scale, scale), 0, 1)
        own = 1 / np.maximum(1.0, (correlation * (correlation > 0.3)).sum(axis=1))
    return posterior, toxic, clean, own


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 30, near: float = 1e-7) -> tuple[np.ndarray, float]:
    """Weights of a logistic regression on soft labels: Newton steps, halved until the loss falls, to convergence."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5 * (ridge * w * w).sum())

    before = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(x) + ridge * w
        h = (x.T @ (x * np.maximum(p * (1 - p), 1e-9)[:, None].astype(x.dtype))).astype(np.float64) / len(x)
        step = np.linalg.solve(h + np.diag(ridge + 1e-9), g)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        after = loss(w)
        if before - after < near:
            break
        before = after
    return w[:-1], float(w[-1])


def drawn(code: Column, share: float) -> Column:
    """Whether a row of hash ``code`` is among ``share`` of all: 53 bits of it are a number from 0 to 1, so that the share may be as small as labels are many."""
    place = F.pmod(code, F.lit(1 << 20)) * float(1 << 33) + F.shiftrightunsigned(code, 31)
    return place / float(1 << 53) < share


def fit(docs: DataFrame, labels: DataFrame, known: Column, text: str = "text", doc_id: str = "doc_id", sample: int = 12_000, voters: int = 200, kept: int = 800, least: float = 20.0, precise: float = 0.7) -> Model:
    """Learn from labelled rows of ``docs`` where ``known`` (over doc_id) holds.

    At most about ``sample`` labelled documents are used, those of least hash;
    of rows that share an id the least text counts. Gold labels pick the voters, of the
    lexicon's candidates, and start their rates; the label model then fits rates and
    correlations to the votes alone. ``voters`` and ``kept`` bound the voters and the classifier's features, and
    ``least`` and ``precise`` are the G statistic and the share of toxic documents that a voter needs.
    """
    marks = labels.where(known & F.col("toxic").isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = marks.count()
    share = min(1.0, sample / max(1, total))
    marks = marks.where(drawn(F.xxhash64(F.lit(11), "__id"), share))
    # The sample is bounded, so its marks (12 bytes each) may be broadcast. Of rows that share an id one is learned.
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("text")).join(F.broadcast(marks), "__id")
    rows = rows.groupBy("__id", "toxic").agg(F.min("text").alias("text"))

    def explode(texts: list[str]) -> dict[str, list]:
        code, doc = distinct(*features(texts))
        code = code.view(np.int64)
        return {"codes": [code[a:b].tolist() for a, b in zip(np.searchsorted(doc, np.arange(len(texts))), np.searchsorted(doc, np.arange(len(texts)), side="right"), strict=True)]}

    from .common import cut

    seen = cut(map_texts(rows.select("__id", "toxic", "text"), explode, "codes array<long>"))
    classes = {r["toxic"]: r["n"] for r in seen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 if n1 and not n0 else -30.0, {}, np.zeros(0))
    if not n1 or not n0:
        return empty
    by_code = seen.select("toxic", F.explode("codes").alias("code")).groupBy("code").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).where("pos + neg >= 4")
    p, q = F.col("pos").cast("double"), F.col("neg").cast("double")
    n = float(n1 + n0)
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    g = 2 * (part(p, (p + q) * n1 / n) + part(q, (p + q) * n0 / n) + part(n1 - p, (n - p - q) * n1 / n) + part(n0 - q, (n - p - q) * n0 / n))
    top = by_code.withColumn("g", g).where(f"g >= {least / 2}").orderBy(F.desc("g"), "code").limit(kept).collect()
    if not top:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(n1 / n0)), {}, np.zeros(0))
    codes = np.sort(np.array([r["code"] for r in top], dtype=np.int64).view(np.uint64))
    place = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    hits = seen.select("__id", "toxic", F.array_intersect("codes", F.lit([r["code"] for r in top])).alias("codes")).orderBy("__id").collect()
    x = np.zeros((len(hits), len(codes)), dtype=np.float32)
    for i, r in enumerate(hits):
        x[i, [place[c] for c in r["codes"]]] = 1
    lexicon = [place[r["code"]] for r in sorted(top, key=lambda r: -r["g"]) if r["g"] >= least and (r["pos"] + 0.5) / (r["pos"] + r["neg"] + 1) >= precise][:voters]
    if not lexicon:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(n1 / n0)), {}, np.zeros(0))
    fired = x[:, lexicon].sum(axis=1)
    votes = np.hstack([x[:, lexicon], np.stack([fired >= 2, fired >= 5, fired == 0], axis=1)]).astype(np.float32)
    rate = {place[r["code"]]: (r["pos"] / n1, r["neg"] / n0) for r in top}
    start = (np.array([rate[i][0] for i in lexicon] + [0.9, 0.8, 0.05]), np.array([rate[i][1] for i in lexicon] + [0.1, 0.02, 0.9]))
    posterior, toxic, clean, own = label_model(votes, n1 / n, start)
    w, b = logistic(x, posterior)
    return Model(codes, w, b, dict(enumerate(zip(toxic.tolist(), clean.tolist(), strict=True))), own)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace ``text`` by score and predicted."""
    codes, weights = model.codes, model.weights
    near = np.zeros(1 << 16, dtype=bool)
    near[(codes & U(0xFFFF)).astype(np.int64)] = True

    def judge(texts: list[str]) -> dict[str, list]:
        total = np.full(len(texts), model.bias)
        if len(codes):
            code, doc = features(texts)
            maybe = near[(code & U(0xFFFF)).astype(np.int64)]
            code, doc = code[maybe], doc[maybe]
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[at] == code
            pairs = np.unique(doc[hit] * len(codes) + at[hit])
            total += np.bincount(pairs // len(codes), weights=weights[pairs % len(codes)], minlength=len(texts))
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return {"score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))}

    return map_texts(docs, judge, "score double, predicted int", text)


def op7_score_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score(docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text"), model)

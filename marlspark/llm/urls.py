"""URL filters: rules, and naive Bayes over words that host segmentation finds.

Rules name a host and the start of a path; a rule fits its host, all subdomains and
all paths that start so, and the longest that fits decides. All other URLs are judged
by multinomial naive Bayes, learned from those that rules decide, over tokens of
host and path. Host labels are concatenated words: a unigram Viterbi split, with
word counts of all pages' own text, finds them.

Word counts, segmentation and class counts cover all pages. The class counts are
folded into a fixed number of buckets, so what is broadcast does not grow.

Cases: a null URL, and one without ``://``, has empty host and path, fits no rule and
is judged by the class balance; null html counts no word; where no rule decides any
URL the verdict is allow with score 0.5; rows are judged alone, so repeated rows repeat;
words of more than ``longest`` letters are not in the dictionary: in a host they split
into shorter ones, known or unknown; hosts and paths may have any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BUCKETS = 1 << 16
LONGEST = 20  # letters of a word
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, or null, and its verdict. ``rules`` is a short list that goes into the plan."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        name, verdict = F.when(fits, r).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def word_counts(html: Column, pages: DataFrame, longest: int = LONGEST) -> DataFrame:
    """word and n: runs of at most ``longest`` ASCII letters in the pages' text, tags left out."""
    bare = F.regexp_replace(F.lower(html), "<[^>]*>", " ")
    words = pages.select(F.explode(F.split(bare, "[^a-z]+")).alias("word"))
    return words.where(F.length("word").between(1, longest)).groupBy("word").agg(F.count("*").alias("n"))


def split_word(label: str, counts: dict[str, int], total: int, longest: int = LONGEST) -> list[str]:
    """The most probable split; an unknown word of k letters has probability 10 / (total * 10^k)."""
    best, back = [0.0], [0]
    for i in range(1, len(label) + 1):
        top, at = -math.inf, i - 1
        for j in range(max(0, i - longest), i):
            w = label[j:i]
            n = counts.get(w)
            p = best[j] + (math.log(n / total) if n else math.log(10 / total) - len(w) * math.log(10))
            if p > top:
                top, at = p, j
        best.append(top)
        back.append(at)
    out, i = [], len(label)
    while i:
        out.append(label[back[i] : i])
        i = back[i]
    return out[::-1]


def substrings(labels: DataFrame, longest: int) -> DataFrame:
    """key and word: every distinct run of at most ``longest`` letters of each label. A label goes by its hash, so rows grow with its length alone."""
    starts = F.regexp_extract_all("label", F.lit(f"(?=([a-z]{{1,{longest}}}))"), F.lit(1))
    runs = labels.select("key", F.explode(F.array_distinct(starts)).alias("run"))
    return runs.select("key", F.explode(F.expr("transform(sequence(1, length(run)), k -> substring(run, 1, k))")).alias("word")).distinct()


def segmented_hosts(hosts: DataFrame, counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """host and words of the distinct ``hosts``; every label gets the counts of its own substrings alone.

    The join meets at the words. Those of many labels ("a", "e") have one row each among the counts, so Spark may
    split the labels' side, which is the only hot one.
    """
    counts = cut(counts)  # one pass over all html
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    # A label is told by its hash; two that shared one would only see each other's words.
    labels = hosts.select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("pos", "label")).where("label != ''").withColumn("key", F.xxhash64("label"))
    distinct = labels.select("key", "label").distinct()
    known = substrings(distinct, longest).join(counts, "word").groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [split_word(label, {x["word"]: x["n"] for x in known or ()}, total, longest) for label, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], names=["label", "words"])

    found = distinct.join(known, "key", "left").select("label", "known").mapInArrow(split, "label string, words array<string>")
    rows = labels.drop("key").join(found, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("w"))
    return rows.select("host", F.flatten(F.transform("w", lambda x: x["words"])).alias("words"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", html: str = "html", longest: int = LONGEST) -> DataFrame:
    """``pages`` without html, with host, path, rule, verdict, score (probability of block) and host_words, over columns of these names."""
    host, path = host_and_path(F.col(url))
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    added = ("host", "path", "rule", "verdict", "score", "host_words", html)
    columns = [c for c in pages.columns if c not in added]
    row = F.struct(*[F.col(f"`{c}`") for c in columns] or [F.lit(None).alias("none")]).alias("__row")  # nothing in it can clash
    parsed = pages.select(row, host.alias("__host"), path.alias("__path")).withColumns({"__rule": rule, "__verdict": verdict})
    hosts = cut(segmented_hosts(parsed.select(F.col("__host").alias("host")).distinct(), word_counts(F.col(html), pages, longest), longest))
    joined = parsed.join(hosts, F.col("__host") == F.col("host"), "left").drop("host")
    parts = F.array_remove(F.split(F.regexp_replace(F.lower("__path"), "[0-9]+", "#"), r"[/._=&-]+"), "")
    terms = F.concat(F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w)), F.transform(parts, lambda w: F.concat(F.lit("p:"), w)))
    ready = joined.withColumn("__buckets", F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS))))

    taught = ready.where("__verdict is not null")
    balance = {r[0]: r[1] for r in taught.groupBy("__verdict").count().collect()}
    n = np.zeros((2, BUCKETS))
    for r in taught.select("__verdict", F.explode("__buckets").alias("b")).groupBy("__verdict", "b").count().collect():
        n[int(r[0] == "block"), r[1]] = r[2]
    used = max(1, int((n.sum(axis=0) > 0).sum()))
    logs = np.log((n + 1) / (n.sum(axis=1, keepdims=True) + used))
    weights = logs[1] - logs[0]
    prior = math.log((balance.get("block", 0) + 1) / (balance.get("allow", 0) + 1))

    kept = {c: ready.schema[c].dataType.simpleString() for c in ready.columns if c != "__buckets"}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.get_field_index("__buckets"))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            odds = prior + np.bincount(row, weights=weights[flat], minlength=len(lists))
            yield pa.RecordBatch.from_arrays([*b.select(list(kept)).columns, pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40))))], names=[*kept, "__score"])

    judged = ready.mapInArrow(score, ", ".join(f"`{c}` {k}" for c, k in kept.items()) + ", __score double")
    return judged.select(*[F.col(f"__row.`{c}`").alias(c) for c in columns], F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), F.coalesce("__verdict", F.when(F.col("__score") > 0.5, "block").otherwise("allow")).alias("verdict"), F.col("__score").alias("score"), F.col("words").alias("host_words"))


def op6_judge_urls(spark, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score", F.array_join("host_words", " ").alias("host_words"))

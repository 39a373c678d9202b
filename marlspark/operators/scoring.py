"""Keyword scoring of records against a weighted topic, bands, slices and top lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Rows of the top lists.
TOPS = (10, 50, 100)
BANDS = ("High", "Medium", "Low", "None")


@dataclass(frozen=True)
class Topic:
    name: str
    keywords: tuple[tuple[str, int | float], ...]
    venues: tuple[str, ...] = ()
    years: tuple[int, int] | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @staticmethod
    def of(config: dict) -> Topic:
        """From a parsed configuration: keywords are terms or maps of term and weight (1 by default)."""
        words = tuple((k, 1) if isinstance(k, str) else (k["term"], k.get("weight", 1)) for k in config.get("keywords") or ())
        years = config.get("filter_years")
        span = (int(years.get("start", 0)), int(years.get("end", 9999))) if years else None
        return Topic(str(config.get("topic", "")), words, tuple(config.get("filter_venues") or ()), span)

    @staticmethod
    def parse(spec: str, name: str = "topic") -> Topic:
        """From ``term:weight, term:weight``."""
        return Topic(name, tuple((t.rpartition(":")[0].strip(), int(t.rpartition(":")[2])) for t in spec.split(",")))


#: The topic for the driver's own tables.
SAMPLE_TOPIC = Topic.parse("license:10, los:5, und:5, que:3, of the:2, that:1, the:1, ouou:2", "sample")


def matched(text: Column, topic: Topic) -> Column:
    """Entries of the topic found in the text, in the topic's order; an entry listed twice counts twice."""
    kind = "long" if all(isinstance(w, int) for _, w in topic.keywords) else "double"
    if not topic.keywords:
        return F.array().cast(f"array<struct<term:string,weight:{kind}>>")
    entry = lambda found, t, w: F.when(found, F.struct(F.lit(t).alias("term"), F.lit(w).cast(kind).alias("weight")))

    def hits(low: Column) -> Column:  # of the text folded once
        return F.filter(F.array(*[entry(X.has_folded(low, t) if t.isascii() else X.has_term(text, t), t, w) for t, w in topic.keywords]), lambda x: x.isNotNull())

    return X.let(X.folded(text), hits)


def score(topic: Topic, title: str = "title", abstract: str = "abstract") -> Callable[[DataFrame], DataFrame]:
    """Add relevance_score, matched_keywords and relevance. Row by row: no shuffle, no Python."""
    kind = "long" if all(isinstance(w, int) for _, w in topic.keywords) else "double"

    def apply(df: DataFrame) -> DataFrame:
        text = X.scored_text(F.col(title), F.col(abstract))
        # The matches are kept as one column, so that each pattern runs once.
        found = df.withColumn("__m", matched(text, topic))
        total = F.aggregate("__m", F.lit(0).cast(kind), lambda a, x: a + x["weight"])
        found = found.withColumn("relevance_score", total).withColumn("matched_keywords", F.array_join(F.transform("__m", lambda x: x["term"]), ", "))
        return found.withColumn("relevance", X.relevance(F.col("relevance_score"))).drop("__m")

    return apply


def filter_topic(topic: Topic, venue: str = "venue", year: str = "year") -> Callable[[DataFrame], DataFrame]:
    """Keep the topic's venues, case-blind, and years, inclusive; a filter that is not set keeps all."""

    def apply(df: DataFrame) -> DataFrame:
        if topic.venues:
            df = df.where(F.upper(venue).isin([v.upper() for v in topic.venues]))
        if topic.years:
            df = df.where(F.coalesce(F.nullif(F.col(year).cast("string"), F.lit("")), F.lit("0")).try_cast("int").between(*topic.years))
        return df

    return apply


def min_relevance(label: str, column: str = "relevance") -> Callable[[DataFrame], DataFrame]:
    least = {"None": 0, "Low": 1, "Medium": 2, "High": 3}[label]
    return lambda df: df.where(X.relevance_rank(F.col(column)) >= least)


def distribution(scored: DataFrame) -> DataFrame:
    """Rows of each of the four bands, empty ones included."""
    bands = scored.sparkSession.createDataFrame([(b, i) for i, b in enumerate(BANDS)], "relevance string, place int")
    counts = scored.groupBy("relevance").agg(F.count("*").alias("n"))
    return bands.join(counts, "relevance", "left").select("relevance", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "place")


def by_score(scored: DataFrame, *order: str | Column) -> DataFrame:
    """Best first; rows of equal score keep the order that ``order`` names."""
    return scored.orderBy(F.desc("relevance_score"), *order)


def top(scored: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The n best with a score above 0: a TakeOrdered, not a full sort.

    The filter stands after it, since Spark would score again in a filter below.
    """
    return by_score(scored, *order).limit(n).where("relevance_score > 0")


def slice_scored(scored: DataFrame, min_score: int = 0, top_n: int = 0, order: Sequence[str | Column] = ()) -> DataFrame:
    """Rows of at least ``min_score`` if that is above 0, else the first ``top_n`` in order."""
    value = F.coalesce(F.nullif(F.col("relevance_score").cast("string"), F.lit("")), F.lit("0")).try_cast("int")
    if min_score > 0:
        return scored.where(value >= min_score)
    return scored.orderBy(*order).limit(top_n)


def slice_name(base: str, min_score: int = 0, top_n: int = 0) -> str:
    stem = base.removesuffix(".csv")
    return f"{stem}-score-gte{min_score}.csv" if min_score > 0 else f"{stem}-top{top_n}.csv"


def term_hits(df: DataFrame, topic: Topic, text: str) -> DataFrame:
    """Rows that each term is found in, from one pass: term, weight, n."""
    hits = df.select(F.explode(matched(F.col(text), topic)).alias("m")).select("m.term", "m.weight")
    return hits.groupBy("term", "weight").agg(F.count("*").alias("n"))

"""Queries: topic scoring over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import scoring as S
from ..operators.counting import Counts
from .base import Catalog, table

CATALOG = Catalog()


def _pattern(term: str) -> str:
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_]){term}($|[^\p{{L}}\p{{N}}_])"


_TERMS = S.SAMPLE_TOPIC.keywords
_HITS = ", ".join(f"CASE WHEN regexp_matches(text, '{_pattern(t)}') THEN {i} END" for i, (t, _) in enumerate(_TERMS))
_SCORED = f"""
WITH m AS (SELECT *, list_filter([{_HITS}], lambda x: x IS NOT NULL) AS hits FROM documents),
scored AS (
  SELECT *, CAST(coalesce(list_sum(list_transform(hits, lambda i: [{", ".join(str(w) for _, w in _TERMS)}][i + 1])), 0) AS BIGINT) AS relevance_score,
    array_to_string(list_transform(hits, lambda i: [{", ".join(f"'{t}'" for t, _ in _TERMS)}][i + 1]), ', ') AS matched_keywords FROM m
), banded AS (
  SELECT *, CASE WHEN relevance_score >= 10 THEN 'High' WHEN relevance_score >= 5 THEN 'Medium' WHEN relevance_score >= 1 THEN 'Low' ELSE 'None' END AS relevance FROM scored
)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("title", F.lit(""))
    return docs.transform(S.score(S.SAMPLE_TOPIC, "title", "text"))


@CATALOG.query(_SCORED + " SELECT doc_id, relevance_score, matched_keywords, relevance FROM banded")
def score_documents(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", "relevance_score", "matched_keywords", "relevance")


@CATALOG.query(_SCORED + " SELECT doc_id, relevance_score, relevance FROM banded WHERE relevance_score > 0 ORDER BY relevance_score DESC, doc_id LIMIT 50")
def top_n_scored(spark, sf_dir):
    return S.top(_scored(spark, sf_dir), 50, "doc_id").select("doc_id", "relevance_score", "relevance")


@CATALOG.query(_SCORED + ", best AS (SELECT doc_id, row_number() OVER (ORDER BY relevance_score DESC, doc_id) AS place FROM banded WHERE relevance_score > 0) SELECT n.n AS list_size, b.doc_id, b.place FROM best b JOIN (VALUES (10), (50), (100)) n(n) ON b.place <= n.n")
def top_lists(spark, sf_dir):
    """The three top lists from one TakeOrdered of the longest."""
    from pyspark.sql import Window

    best = S.top(_scored(spark, sf_dir), max(S.TOPS), "doc_id").select("doc_id", "relevance_score")
    ranked = best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("relevance_score"), "doc_id")).cast("long"))
    return ranked.select(F.explode(F.array(*[F.lit(n).cast("long") for n in S.TOPS])).alias("list_size"), "doc_id", "place").where("place <= list_size")


@CATALOG.query(_SCORED + " SELECT v.relevance, count(b.doc_id) AS n FROM (VALUES ('High'), ('Medium'), ('Low'), ('None')) v(relevance) LEFT JOIN banded b ON b.relevance = v.relevance GROUP BY v.relevance")
def band_distribution(spark, sf_dir):
    return S.distribution(_scored(spark, sf_dir)).select("relevance", "n")


@CATALOG.query(_SCORED + " SELECT doc_id, relevance FROM banded WHERE relevance IN ('Medium', 'High')")
def min_relevance(spark, sf_dir):
    return _scored(spark, sf_dir).transform(S.min_relevance("Medium")).select("doc_id", "relevance")


@CATALOG.query(_SCORED + " SELECT doc_id, relevance_score FROM banded WHERE relevance_score >= 4")
def slice_min_score(spark, sf_dir):
    return S.slice_scored(_scored(spark, sf_dir), min_score=4).select("doc_id", "relevance_score")


@CATALOG.query(_SCORED + " SELECT doc_id, relevance_score FROM banded ORDER BY doc_id LIMIT 25")
def slice_top(spark, sf_dir):
    """The first rows in file order, score set aside."""
    return S.slice_scored(_scored(spark, sf_dir), top_n=25, order=("doc_id",)).select("doc_id", "relevance_score")


@CATALOG.query("SELECT t.term, CAST(t.weight AS BIGINT) AS weight, count(*) AS n FROM documents d JOIN (VALUES " + ", ".join(f"('{t}', {w}, '{_pattern(t)}')" for t, w in _TERMS) + ") t(term, weight, p) ON regexp_matches(d.text, t.p) GROUP BY ALL")
def term_hits(spark, sf_dir):
    return S.term_hits(table(spark, sf_dir, "documents"), S.SAMPLE_TOPIC, "text")


@CATALOG.query("SELECT doc_id, lang, source FROM documents WHERE upper(source) IN ('SRC1', 'SRC2', 'SRC3')")
def filter_venue(spark, sf_dir):
    topic = S.Topic("t", (), ("src1", "SRC2", "Src3"))
    return table(spark, sf_dir, "documents").transform(S.filter_topic(topic, "source")).select("doc_id", "lang", "source")


@CATALOG.query("SELECT o_orderkey, year(o_orderdate) AS order_year FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996")
def filter_years(spark, sf_dir):
    topic = S.Topic("t", (), (), (1994, 1996))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"))
    return rows.transform(S.filter_topic(topic, year="order_year"))


@CATALOG.query(f"{_SCORED} SELECT 'read' AS stage, count(*) AS n FROM banded UNION ALL SELECT 'scored', count(*) FILTER (relevance_score > 0) FROM banded UNION ALL SELECT 'medium', count(*) FILTER (relevance IN ('Medium', 'High')) FROM banded")
def stages_in_passing(spark, sf_dir):
    """How many documents each stage of the scoring leaves, from one pass over them."""
    counts = Counts()
    read = counts.at(table(spark, sf_dir, "documents").withColumn("title", F.lit("")), "read")
    scored = counts.at(read.transform(S.score(S.SAMPLE_TOPIC, "title", "text")).where("relevance_score > 0"), "scored")
    counts.run(counts.at(scored.transform(S.min_relevance("Medium")), "medium"))
    return counts.table(spark)


@CATALOG.query("SELECT lang, count(*) AS n, count(*) FILTER (n_chars > 2000) AS kept, sum(n_chars) AS chars FROM documents GROUP BY lang")
def stage_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 2000).alias("kept"), F.sum("n_chars").alias("chars"))


def _highlight_sql() -> str:
    t = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    for term, light in (("license", "60"), ("of the", "28.88888888888889"), ("the", "25")):
        t = f"regexp_replace({t}, '(?i)\\b({term})\\b', '<span class=\"kw\" style=\"color:hsl(43, 80%, {light}%)\">\\1</span>', 'g')"
    return f"SELECT doc_id, md5({t}) AS html_md5 FROM documents"


@CATALOG.query(_highlight_sql())
def highlight(spark, sf_dir):
    """Terms that overlap: the longer one's mark comes first."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.highlighted(F.col("text"), [("the", 1), ("license", 10), ("of the", 2)])).alias("html_md5"))

"""Queries: enrichment from lookups. Labels, customers and nations stand in for external sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import enrich as E
from ..operators import policies as R
from ..operators.dedup import first_by
from ..schemas import UNAVAILABLE
from .base import Catalog, table

CATALOG = Catalog()

_PAPERS = "(SELECT doc_id AS paper_id, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '[abstract unavailable]' WHEN 2 THEN '[error: x]' ELSE text END AS abstract, CASE WHEN doc_id % 7 = 0 THEN '0' WHEN doc_id % 7 = 1 THEN '' ELSE '5' END AS citation_count, CASE WHEN doc_id % 3 = 0 THEN '' ELSE '10.1/' || doc_id END AS doi FROM documents)"


def _papers(spark, sf_dir):
    i = F.col("doc_id")
    abstract = F.when(i % 5 == 0, "").when(i % 5 == 1, UNAVAILABLE).when(i % 5 == 2, "[error: x]").otherwise(F.col("text"))
    cited = F.when(i % 7 == 0, "0").when(i % 7 == 1, "").otherwise("5")
    doi = F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("10.1/"), i.cast("string")))
    return table(spark, sf_dir, "documents").select(i.alias("paper_id"), abstract.alias("abstract"), cited.alias("citation_count"), doi.alias("doi"))


_MISSING = "(abstract IS NULL OR abstract IN ('', '[abstract unavailable]') OR abstract LIKE '[error:%')"


@CATALOG.query(f"SELECT paper_id FROM {_PAPERS} WHERE {_MISSING} OR citation_count IN ('', '0')")
def needs_enrichment(spark, sf_dir):
    return _papers(spark, sf_dir).where(E.needs_enrichment(F.col("abstract"), F.col("citation_count"))).select("paper_id")


@CATALOG.query(f"SELECT paper_id, doi, coalesce(quality, -1) AS quality FROM {_PAPERS} p LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l ON p.doi <> '' AND 'DOI:' || p.doi = 'DOI:10.1/' || l.doc_id")
def doi_left_join(spark, sf_dir):
    """Ids may be answered more than once; the least answer counts, and records are not multiplied."""
    found = table(spark, sf_dir, "labels").select(F.concat(F.lit("DOI:10.1/"), F.col("doc_id").cast("string")).alias("id"), "quality")
    found = found.unionByName(found.withColumn("quality", F.col("quality") + 10))
    return E.by_doi(_papers(spark, sf_dir), found).select("paper_id", "doi", F.coalesce("quality", F.lit(-1)).cast("long").alias("quality"))


_H1 = "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"
_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"


@CATALOG.query(f"""
WITH p AS (SELECT page_id, {_H1} AS title, 'v' || (page_id % 3) AS venue, CASE WHEN page_id % 11 = 0 THEN '' ELSE '2024' END AS year FROM pages),
c AS (SELECT venue, year, {_NORM.format('title')} AS t, min(page_id) AS found FROM p WHERE year <> '' AND {_NORM.format('title')} <> '' GROUP BY ALL)
SELECT p.page_id, c.found FROM p LEFT JOIN c ON p.venue = c.venue AND p.year = c.year AND p.year <> '' AND {_NORM.format('p.title')} = c.t""")
def title_group_join(spark, sf_dir):
    """First candidate of a normalised title within venue and year; blank groups are skipped."""
    from ..functions.html import first_heading

    p = table(spark, sf_dir, "pages").select("page_id", first_heading(F.col("html")).alias("title"), F.concat(F.lit("v"), (F.col("page_id") % 3).cast("string")).alias("venue"), F.when(F.col("page_id") % 11 == 0, "").otherwise("2024").alias("year"))
    pool = p.withColumn("found", F.col("page_id")).where("year != ''")
    return E.by_title_in_group(p, pool, "page_id", ["found"]).select("page_id", "found")


@CATALOG.query(f"""
WITH p AS (SELECT page_id, {_H1} AS title, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '2023' ELSE '2024' END AS year FROM pages)
SELECT a.page_id, min(b.page_id) AS found FROM p a LEFT JOIN p b ON {_NORM.format('a.title')} = {_NORM.format('b.title')} AND {_NORM.format('b.title')} <> '' AND (a.year = '' OR b.year = '' OR a.year = b.year) GROUP BY a.page_id""")
def title_year_join(spark, sf_dir):
    from ..functions.html import first_heading

    year = F.when(F.col("page_id") % 3 == 0, "").when(F.col("page_id") % 3 == 1, "2023").otherwise("2024")
    p = table(spark, sf_dir, "pages").select("page_id", first_heading(F.col("html")).alias("title"), year.alias("year"))
    pool = p.withColumn("found", F.col("page_id"))
    return E.by_title(p, pool, "page_id", "found", ["found"]).select("page_id", "found")


@CATALOG.query(f"""
WITH p AS (SELECT paper_id, CASE WHEN {_MISSING} THEN NULL ELSE abstract END AS a FROM {_PAPERS}),
s AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'q' || doc_id END AS a FROM labels), c AS (SELECT c_custkey AS k, 'c' || c_custkey AS a FROM customer)
SELECT paper_id, md5(coalesce(p.a, s.a, c.a, '[abstract unavailable]')) AS abstract_md5, CASE WHEN p.a IS NOT NULL THEN 'original' WHEN s.a IS NOT NULL THEN 'batch' WHEN c.a IS NOT NULL THEN 'search' ELSE 'none' END AS filled_from
FROM p LEFT JOIN s ON s.doc_id = p.paper_id LEFT JOIN c ON c.k = p.paper_id""")
def enrich_cascade(spark, sf_dir):
    batch = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 1, F.concat(F.lit("q"), F.col("doc_id").cast("string"))).alias("abstract"))
    search = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("abstract"))
    return E.cascade(_papers(spark, sf_dir), [("batch", batch), ("search", search)]).select("paper_id", F.md5("abstract").alias("abstract_md5"), "filled_from")


@CATALOG.query(f"""
WITH p AS (SELECT paper_id, CASE WHEN {_MISSING} THEN NULL ELSE abstract END AS a FROM {_PAPERS}), s AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'q' END AS a FROM labels), c AS (SELECT c_custkey AS k FROM customer)
SELECT CASE WHEN p.a IS NOT NULL THEN 'original' WHEN s.a IS NOT NULL THEN 'batch' WHEN c.k IS NOT NULL THEN 'search' ELSE 'none' END AS filled_from, count(*) AS n FROM p LEFT JOIN s ON s.doc_id = p.paper_id LEFT JOIN c ON c.k = p.paper_id GROUP BY 1""")
def enrichment_counters(spark, sf_dir):
    """What each step of a cascade filled, with what had a value and what has none."""
    batch = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 1, "q").alias("abstract"))
    search = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), F.lit("c").alias("abstract"))
    return E.fill_counts(E.cascade(_papers(spark, sf_dir), [("batch", batch), ("search", search)]))


@CATALOG.query(f"SELECT count(*) AS asked, count(l.doc_id) AS enriched, count(l.doc_id) FILTER (abstract <> '' AND NOT starts_with(abstract, '[')) AS abstracts FROM {_PAPERS} p LEFT JOIN labels l ON l.doc_id = p.paper_id")
def lookup_counters(spark, sf_dir):
    """Of the ids asked for, how many were found, and how many of those with a text."""
    found = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), F.lit(True).alias("found"))
    return E.lookup_counts(_papers(spark, sf_dir).join(found, "paper_id", "left").withColumn("found", F.coalesce("found", F.lit(False))))


@CATALOG.query(f"SELECT p.paper_id, CASE WHEN coalesce(u.v, '') <> '' THEN u.v ELSE p.citation_count END AS citation_count FROM {_PAPERS} p LEFT JOIN (SELECT user_id AS paper_id, arg_max(v, event_id) AS v FROM (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS v FROM events) GROUP BY user_id) u ON p.paper_id = u.paper_id")
def merge_back(spark, sf_dir):
    """New values that are not blank overwrite; the last update of a key counts."""
    updates = table(spark, sf_dir, "events").select(F.col("user_id").alias("paper_id"), "event_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("citation_count"))
    return E.merge_back(_papers(spark, sf_dir), updates, ["citation_count"], order="event_id").select("paper_id", "citation_count")


@CATALOG.query("SELECT d.doc_id AS paper_id, CASE WHEN l.doc_id IS NULL THEN 'new' ELSE 'q' || l.quality END AS keep, CASE WHEN l.doc_id IS NULL THEN '' ELSE 't' || l.toxic END AS notes FROM documents d LEFT JOIN labels l USING (doc_id)")
def human_reattach(spark, sf_dir):
    """The earlier output may list a record more than once; its last row there counts."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.lit("new").alias("keep"), F.lit("").alias("notes"))
    earlier = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("paper_id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("keep"), F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("notes"), F.lit(2).alias("_row"))
    before = earlier.withColumns({"keep": F.lit("z"), "notes": F.lit("z"), "_row": F.lit(1)})
    return E.reattach(rows, earlier.unionByName(before))


@CATALOG.query("SELECT lang, source, count(*) AS n, least(greatest(count(*) * 4, 25), 200) AS candidates FROM documents GROUP BY lang, source")
def group_limits(spark, sf_dir):
    return E.group_limits(table(spark, sf_dir, "documents"), "lang", "source")


@CATALOG.query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, '' AS arxiv_id, '' AS s2_paper_id, 'T' || doc_id AS title, '' AS authors, '' AS year, source AS venue, '' AS abstract, source, '' AS categories, '0' AS citation_count, '' AS url, '' AS doi, '' AS published_date, '2026-01-31' AS crawled_date, '' AS keep, '' AS notes FROM documents")
def column_defaults(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.col("source").alias("venue"), "source", F.lit(None).cast("string").alias("abstract"))
    return E.with_defaults(rows, "2026-01-31")


@CATALOG.query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, lang AS title, '' AS authors, '' AS year, '' AS venue, '' AS doi, '' AS url, '' AS dblp_id FROM documents")
def fixed_projection(spark, sf_dir):
    from ..schemas import DB

    return E.project(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("paper_id"), F.col("lang").alias("title"), "source"), DB.fieldNames())


@CATALOG.query(f"SELECT min(page_id) AS page_id, {_NORM.format(_H1)} AS t FROM pages GROUP BY t")
def first_candidate(spark, sf_dir):
    from ..functions.html import first_heading

    p = table(spark, sf_dir, "pages").select("page_id", X.normalized_title(first_heading(F.col("html"))).alias("t"))
    return p.transform(first_by("t", "page_id"))


_MISS = "({0} IS NULL OR {0} IN ('', '[abstract unavailable]') OR starts_with({0}, '[error:'))".format
_T = _NORM.format
_RECORDS = f"""
WITH h AS (SELECT page_id, {_H1} AS title FROM pages),
p AS (
  SELECT page_id AS place, CAST(CASE WHEN page_id % 50 = 49 THEN page_id - 1 ELSE page_id END AS VARCHAR) AS paper_id, title, 'v' || (page_id % 3) AS venue,
    CASE WHEN page_id % 11 = 0 THEN '' ELSE '2024' END AS year, CASE WHEN page_id % 2 = 0 THEN '10.1/' || page_id ELSE '' END AS doi,
    CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN '[abstract unavailable]' WHEN 2 THEN '[error: x]' ELSE 'own' END AS abstract,
    CASE WHEN page_id % 7 = 0 THEN '0' ELSE '5' END AS citation_count, CASE WHEN page_id % 4 = 1 THEN 'a' || page_id ELSE '' END AS arxiv_id,
    CASE WHEN page_id % 3 = 0 THEN 'own' ELSE '' END AS categories, '' AS s2_paper_id, '' AS published_date FROM h
), due AS (SELECT *, {_MISS('abstract')} OR citation_count IN ('', '0') AS live FROM p),
labelled AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
b AS (
  SELECT due.* EXCLUDE (citation_count, s2_paper_id, abstract, arxiv_id, published_date, categories), l.doc_id IS NOT NULL AS hit,
    CASE WHEN hit THEN CAST(coalesce(l.quality, 0) AS VARCHAR) ELSE citation_count END AS citation_count, CASE WHEN hit THEN 's' || l.doc_id ELSE s2_paper_id END AS s2_paper_id,
    CASE WHEN hit AND l.toxic = 1 AND {_MISS('abstract')} THEN 'batch ' || l.doc_id ELSE abstract END AS abstract,
    CASE WHEN hit AND l.quality = 1 THEN 'b' || l.doc_id ELSE arxiv_id END AS arxiv_id, CASE WHEN hit THEN '2024-01-02' ELSE published_date END AS published_date,
    CASE WHEN hit AND categories = '' THEN 'f; g' ELSE categories END AS categories,
    CASE WHEN hit AND l.toxic = 1 AND {_MISS('due.abstract')} THEN 'batch' END AS o_abstract, CASE WHEN hit THEN 'batch' END AS o_count
  FROM due LEFT JOIN labelled l ON due.live AND due.doi = '10.1/' || l.doc_id
), pool AS (
  SELECT 'v' || (page_id % 3) AS venue, {_T('title')} AS t, min(page_id) AS found FROM h WHERE {_T('title')} <> '' AND page_id % 5 <> 0 GROUP BY ALL
), k AS (
  SELECT b.* REPLACE (
    CASE WHEN found IS NULL THEN citation_count ELSE '7' END AS citation_count, CASE WHEN found IS NULL THEN s2_paper_id ELSE 'k' || found END AS s2_paper_id,
    CASE WHEN found % 2 = 0 THEN 'bulk ' || found ELSE abstract END AS abstract, CASE WHEN found % 2 = 0 THEN 'bulk' ELSE o_abstract END AS o_abstract,
    CASE WHEN found IS NULL THEN o_count ELSE 'bulk' END AS o_count)
  FROM b LEFT JOIN pool ON b.live AND b.doi = '' AND {_MISS('b.abstract')} AND b.year = '2024' AND b.venue = pool.venue AND {_T('b.title')} = pool.t
), c AS (SELECT page_id, {_T('title')} AS t, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '2023' ELSE '2024' END AS year FROM h WHERE {_T('title')} <> ''),
f AS (
  SELECT k.place, min(c.page_id) AS found FROM k JOIN c ON k.live AND k.doi = '' AND {_MISS('k.abstract')} AND {_T('k.title')} = c.t AND (k.year = '' OR c.year = '' OR k.year = c.year) GROUP BY k.place
), s AS (
  SELECT k.* REPLACE (
    CASE WHEN found IS NULL THEN citation_count ELSE '0' END AS citation_count, CASE WHEN found IS NULL THEN s2_paper_id ELSE '' END AS s2_paper_id,
    CASE WHEN found % 3 = 0 THEN 'search ' || found WHEN found IS NULL AND live AND doi = '' AND trim(title) <> '' AND {_MISS('abstract')} THEN '[abstract unavailable]' ELSE abstract END AS abstract,
    CASE WHEN found % 3 = 0 THEN 'search' WHEN found IS NULL AND live AND doi = '' AND trim(title) <> '' AND {_MISS('abstract')} THEN 'none' ELSE o_abstract END AS o_abstract,
    CASE WHEN found IS NULL THEN o_count ELSE 'search' END AS o_count)
  FROM k LEFT JOIN f USING (place)
), g AS (
  SELECT s.* REPLACE (CASE WHEN r.c_custkey IS NULL THEN abstract WHEN r.c_acctbal < 0 THEN '[error: HTTP 500]' ELSE 'c' || r.c_custkey END AS abstract, CASE WHEN r.c_custkey IS NULL THEN o_abstract ELSE 'registry' END AS o_abstract)
  FROM s LEFT JOIN customer r ON s.live AND {_MISS('s.abstract')} AND s.doi = '10.1/' || r.c_custkey
), x AS (
  SELECT g.* REPLACE (CASE WHEN r.s_suppkey IS NULL THEN abstract WHEN r.s_suppkey % 3 = 0 THEN '[error: timeout]' ELSE 'arxiv ' || r.s_suppkey END AS abstract, CASE WHEN r.s_suppkey IS NULL THEN o_abstract ELSE 'preprints' END AS o_abstract)
  FROM g LEFT JOIN supplier r ON g.live AND {_MISS('g.abstract')} AND g.arxiv_id IN ('a' || r.s_suppkey, 'b' || r.s_suppkey)
), m AS (SELECT x.* REPLACE (CASE WHEN live AND abstract = '' THEN '[abstract unavailable]' ELSE abstract END AS abstract, CASE WHEN live AND abstract = '' THEN 'none' ELSE o_abstract END AS o_abstract) FROM x),
l AS (SELECT * FROM m WHERE live QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY place DESC) = 1),
records AS (
  SELECT m.paper_id, coalesce(nullif(l.citation_count, ''), m.citation_count) AS citation_count, coalesce(nullif(l.s2_paper_id, ''), m.s2_paper_id) AS s2_paper_id,
    coalesce(nullif(l.abstract, ''), m.abstract) AS abstract, coalesce(nullif(l.arxiv_id, ''), m.arxiv_id) AS arxiv_id, coalesce(nullif(l.published_date, ''), m.published_date) AS published_date,
    coalesce(nullif(l.categories, ''), m.categories) AS categories, coalesce(nullif(l.doi, ''), m.doi) AS doi, CASE WHEN l.place IS NULL THEN m.o_abstract ELSE l.o_abstract END AS abstract_from, CASE WHEN l.place IS NULL THEN m.o_count ELSE l.o_count END AS citation_count_from
  FROM m LEFT JOIN l USING (paper_id)
)"""


def _records(spark, sf_dir):
    """Pages stand for records and for what a search finds; labels, customers and suppliers for services."""
    from ..functions.html import first_heading

    i = F.col("page_id")
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    h = table(spark, sf_dir, "pages").select("page_id", first_heading(F.col("html")).alias("title"))
    papers = h.select(
        i.alias("at"), F.when(i % 50 == 49, i - 1).otherwise(i).alias("paper_id"), "title", F.concat(F.lit("v"), (i % 3).cast("string")).alias("venue"),
        F.when(i % 11 == 0, "").otherwise("2024").alias("year"), F.when(i % 2 == 0, name("10.1/", "page_id")).alias("doi"),
        F.when(i % 5 == 0, "").when(i % 5 == 1, UNAVAILABLE).when(i % 5 == 2, "[error: x]").otherwise("own").alias("abstract"),
        F.when(i % 7 == 0, "0").otherwise("5").alias("citation_count"), F.when(i % 4 == 1, name("a", "page_id")).alias("arxiv_id"), F.when(i % 3 == 0, "own").alias("categories"),
    )
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    batch = labels.select(
        name("DOI:10.1/", "doc_id").alias("id"), name("s", "doc_id").alias("s2_paper_id"), F.col("quality").alias("citation_count"), F.when(F.col("toxic") == 1, name("batch ", "doc_id")).alias("abstract"),
        F.when(F.col("quality") == 1, name("b", "doc_id")).alias("arxiv_id"), F.lit("2024-01-02T10:00:00").alias("published_date"), F.array(F.lit("f"), F.lit("g")).alias("fields_of_study"),
    )
    bare = {"arxiv_id": F.lit(None).cast("string"), "published_date": F.lit(""), "fields_of_study": F.array().cast("array<string>"), "rank": i}
    own = F.when(i % 5 == 0, "2023").when(i % 5 == 1, "").otherwise("2024")
    bulk = h.withColumns({**bare, "venue": F.concat(F.lit("v"), (i % 3).cast("string")), "year": F.lit("2024"), "candidate_year": own, "s2_paper_id": name("k", "page_id"), "citation_count": F.lit(7), "abstract": F.when(i % 2 == 0, name("bulk ", "page_id"))})
    year = F.when(i % 3 == 0, "").when(i % 3 == 1, "2023").otherwise("2024")
    search = h.withColumns({**bare, "year": year, "s2_paper_id": F.lit(None).cast("string"), "citation_count": F.lit(None).cast("int"), "abstract": F.when(i % 3 == 0, name("search ", "page_id"))})
    registry = table(spark, sf_dir, "customer").select(name("10.1/", "c_custkey").alias("doi"), F.format_string("<jats:p> c%d</jats:p>", "c_custkey").alias("abstract"), F.when(F.col("c_acctbal") < 0, "[error: HTTP 500]").alias("error"))
    preprints = table(spark, sf_dir, "supplier").select(F.explode(F.array(name("a", "s_suppkey"), name("b", "s_suppkey"))).alias("arxiv_id"), name("arxiv ", "s_suppkey").alias("abstract"), F.when(F.col("s_suppkey") % 3 == 0, "[error: timeout]").alias("error"))
    return R.enrich_table(papers, "2026-01-31", ["at"], batch, bulk, search, registry, preprints)


@CATALOG.query(_RECORDS + " SELECT * FROM records")
def enrich_records(spark, sf_dir):
    """A table enriched by five sources under their field rules, with where abstract and citations came from."""
    return _records(spark, sf_dir).select("paper_id", "citation_count", "s2_paper_id", "abstract", "arxiv_id", "published_date", "categories", "doi", F.col("origin.abstract").alias("abstract_from"), F.col("origin.citation_count").alias("citation_count_from"))


@CATALOG.query(_RECORDS + " SELECT 'abstract' AS field, coalesce(abstract_from, 'original') AS source, count(*) AS n FROM records GROUP BY ALL UNION ALL SELECT 'citation_count', coalesce(citation_count_from, 'original'), count(*) FROM records GROUP BY ALL")
def enrich_origins(spark, sf_dir):
    """How many values of a field each source wrote last."""
    return R.origin_counts(_records(spark, sf_dir)).where(F.col("field").isin("abstract", "citation_count"))

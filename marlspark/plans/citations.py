"""Queries: the citation graph of documents, whose references are the lines of orders.

Blocks of six documents share ids in a chain: a DOI for two, a preprint for the second and third. An order
stands for the document of its number that cites the part of each line; ends are named by all three kinds of id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import citations as C
from .base import Catalog, table

CATALOG = Catalog()

_PAPERS = """SELECT doc_id AS paper_id, CASE WHEN doc_id % 3 = 0 THEN 'S2:s' || doc_id END AS s2, 'DOI:10.1/x' || (doc_id // 2) AS doi,
  CASE WHEN doc_id % 6 IN (1, 2) THEN 'ARXIV:24.' || (doc_id // 3) WHEN doc_id % 6 = 3 THEN 'ARXIV:25.' || doc_id END AS arxiv FROM documents WHERE doc_id IS NOT NULL"""
_NAMES = "SELECT paper_id, s2 AS alias FROM p WHERE s2 IS NOT NULL UNION ALL SELECT paper_id, doi FROM p UNION ALL SELECT paper_id, arxiv FROM p WHERE arxiv IS NOT NULL"
_WORKS = f"""WITH RECURSIVE p AS ({_PAPERS}), a AS ({_NAMES}), l AS (SELECT DISTINCT x.paper_id AS u, y.paper_id AS v FROM a x JOIN a y USING (alias)),
r AS (SELECT paper_id AS u, paper_id AS v FROM p UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u), w AS (SELECT u AS paper_id, min(v) AS work FROM r GROUP BY u)"""
_EDGES = f"""{_WORKS}, names AS (SELECT alias, min(work) AS work FROM a JOIN w USING (paper_id) GROUP BY alias), refs AS (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN 'S2:s' || l_orderkey ELSE 'DOI:10.1/x' || (l_orderkey // 2) END AS citing,
    CASE l_linenumber % 3 WHEN 0 THEN 'S2:s' || l_partkey WHEN 1 THEN 'DOI:10.1/x' || (l_partkey // 2) ELSE 'ARXIV:24.' || (l_partkey // 3) END AS cited FROM lineitem
), e AS (SELECT x.work AS citing, y.work AS cited, count(*) AS n FROM refs JOIN names x ON x.alias = refs.citing JOIN names y ON y.alias = refs.cited WHERE x.work <> y.work GROUP BY ALL),
d AS (SELECT work, (SELECT count(*) FROM e WHERE e.citing = k.work) AS cites, (SELECT count(*) FROM e WHERE e.cited = k.work) AS cited_by FROM (SELECT DISTINCT work FROM w) k)"""


def _papers(spark, sf_dir):
    i = F.col("doc_id")
    text = lambda start, c: F.concat(F.lit(start), c.cast("string"))
    third = F.when((i % 6).isin(1, 2), F.concat(text("24.", F.floor(i / 3)), F.lit("v"), (i % 6).cast("string"))).when(i % 6 == 3, text("25.", i)).otherwise("")
    return table(spark, sf_dir, "documents").select(
        i.alias("paper_id"), F.when(i % 3 == 0, text("s", i)).alias("s2_paper_id"), F.when(i % 2 == 0, text("10.1/X", F.floor(i / 2))).otherwise(text(" 10.1/x", F.floor(i / 2))).alias("doi"), third.alias("arxiv_id")
    )


def _references(spark, sf_dir):
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    text = lambda start, c: F.concat(F.lit(start), c.cast("string"))
    citing = F.when(order % 3 == 0, text("S2:s", order)).otherwise(text("DOI:10.1/x", F.floor(order / 2)))
    kind = F.col("l_linenumber") % 3
    cited = F.when(kind == 0, text("S2:s", part)).when(kind == 1, text("DOI:10.1/x", F.floor(part / 2))).otherwise(text("ARXIV:24.", F.floor(part / 3)))
    return table(spark, sf_dir, "lineitem").select(citing.alias("citing"), cited.alias("cited"))


def _graph(spark, sf_dir):
    papers = _papers(spark, sf_dir)
    members = C.works(papers)
    return members, C.edges_inside(_references(spark, sf_dir), papers, members)


@CATALOG.query(f"{_WORKS} SELECT paper_id, work, coalesce(s2, doi, arxiv) AS asked FROM p JOIN w USING (paper_id)")
def citation_works(spark, sf_dir):
    """Which papers are one work, and the id by which each one's references are asked for."""
    papers = _papers(spark, sf_dir)
    return C.works(papers).join(papers.select("paper_id", C.lookup_id().alias("asked")), "paper_id")


@CATALOG.query(f"{_EDGES} SELECT citing, cited, n FROM e")
def citation_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@CATALOG.query(f"{_EDGES} SELECT work, cites, cited_by FROM d")
def citation_degrees(spark, sf_dir):
    members, edges = _graph(spark, sf_dir)
    return C.degrees(edges, members)


@CATALOG.query(f"{_EDGES} SELECT count(*) AS n_works, count(*) FILTER (cites = 0 AND cited_by = 0) AS n_isolated, max(cites) AS most_cites, max(cited_by) AS most_cited_by, (SELECT count(*) FROM e) AS n_edges FROM d")
def citation_summary(spark, sf_dir):
    members, edges = _graph(spark, sf_dir)
    return C.summary(edges, C.degrees(edges, members))

"""Queries: remote services, with the driver's tables as their answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import lookups as L
from ..sources import services as S
from ..sources import tables as T
from ..streaming import stages
from .base import Catalog, table

CATALOG = Catalog()


@CATALOG.query("SELECT source, count(*) OVER (PARTITION BY source) AS total, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, 'p' || doc_id AS paper_id, md5(text) AS abstract_md5, '10.1/' || doc_id AS doi, n_chars AS citations FROM documents")
def search_payloads(spark, sf_dir):
    """Bulk answers, one for each source, as rows; a null and a broken answer have none."""
    i = F.col("doc_id").cast("string")
    paper = F.struct(F.concat(F.lit("p"), i).alias("paperId"), F.col("text").alias("abstract"), F.struct(F.concat(F.lit("10.1/"), i).alias("DOI")).alias("externalIds"), F.col("n_chars").alias("citationCount"))
    lists = table(spark, sf_dir, "documents").groupBy("source").agg(F.sort_array(F.collect_list(F.struct("doc_id", paper.alias("p")))).alias("l"))
    answers = lists.select("source", F.to_json(F.struct(F.lit("next").alias("token"), F.transform("l", lambda x: x["p"]).alias("data"))).alias("payload"))
    more = spark.createDataFrame([("none", None), ("broken", "{"), ("empty", '{"total": 0, "data": []}')], "source string, payload string")
    rows = S.search_results(answers.unionByName(more))
    return rows.select("source", "total", F.col("place").cast("long").alias("place"), F.col("paperId").alias("paper_id"), F.md5("abstract").alias("abstract_md5"), F.col("externalIds.DOI").alias("doi"), F.col("citationCount").alias("citations"))


@CATALOG.query("SELECT d.doc_id, l.doc_id IS NOT NULL AS found, CASE WHEN l.doc_id IS NOT NULL THEN 'p' || d.doc_id END AS paper_id, l.quality AS citations FROM documents d LEFT JOIN labels l USING (doc_id)")
def lookup_payloads(spark, sf_dir):
    """Answers to lookups by id, not found ones among them."""
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    payload = F.when(F.col("quality").isNotNull(), F.to_json(F.struct(F.concat(F.lit("p"), F.col("doc_id").cast("string")).alias("paperId"), F.col("quality").alias("citationCount"))))
    rows = S.paper_results(joined.select("doc_id", payload.alias("payload")))
    return rows.select("doc_id", "found", F.col("paperId").alias("paper_id"), F.col("citationCount").alias("citations"))


@CATALOG.query("SELECT doc_id, md5(trim(coalesce(text, ''))) AS abstract_md5 FROM documents")
def registry_works(spark, sf_dir):
    """Registry answers with marked-up abstracts."""
    marked = F.concat(F.lit('<jats:p xml:lang="en">'), "text", F.lit("</jats:p>"))
    payload = F.to_json(F.struct(F.struct(marked.alias("abstract")).alias("message")))
    return S.works(table(spark, sf_dir, "documents").select("doc_id", payload.alias("payload"))).select("doc_id", F.md5("abstract").alias("abstract_md5"))


_CODES = (0, 200, 404, 429, 500, 503, 418)


@CATALOG.query(f"SELECT event_id, CASE WHEN c = 429 AND r > 0 THEN r WHEN c = 429 THEN least(pow(2, a + 2), 60) WHEN c IN (0, 500, 502, 503, 504) AND a < 2 THEN pow(2, a + 1) END AS wait FROM (SELECT event_id, list_extract([{', '.join(map(str, _CODES))}], event_id % 7 + 1) AS c, user_id % 3 AS a, CASE WHEN event_id % 2 = 0 THEN CAST(value AS DOUBLE) END AS r FROM events)")
def retry_waits(spark, sf_dir):
    """How long to wait after each answer: as told, doubling, or not at all."""
    e = table(spark, sf_dir, "events")
    code = F.element_at(F.array(*map(F.lit, _CODES)), (F.col("event_id") % 7 + 1).cast("int"))
    told = F.when(F.col("event_id") % 2 == 0, F.when(F.col("value") > 0, F.col("value").cast("double")))
    return e.select("event_id", S.lookup_wait_column(code, F.col("user_id") % 3, told).alias("wait"))


@CATALOG.query("SELECT doc_id, quality FROM labels")
def batch_lookup(spark, sf_dir):
    """Ids asked for in batches; those without an answer have no row."""
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id")).join(known, "id", "left")
    asked = ids.select(F.concat_ws(":", "id", F.col("quality").cast("string")).alias("id"))  # the stand-in service knows what an id carries
    answer = lambda keys: [{"quality": int(k.partition(":")[2])} if ":" in k else None for k in keys]
    found = T.lookup_batches(asked, answer, "id string, quality long")
    return found.select(F.substring_index("id", ":", 1).cast("long").alias("doc_id"), "quality")


@CATALOG.query("SELECT doc_id, doc_id * 31 % 101 AS score, 'DOI:10.1/' || doc_id AS doi FROM documents WHERE doc_id % 7 <> 0 AND doc_id * 31 % 101 > 20")
def lookup_format(spark, sf_dir):
    """The documents' ids asked for as a data source, by row groups, 500 a call; some have no answer."""
    answers = lambda ids: [{"score": i * 31 % 101, "doi": f"DOI:10.1/{i}"} if i % 7 else None for i in ids]
    spark.dataSource.register(L.lookup_format("lookups_by_id", answers, "doc_id long, score long, doi string", key="doc_id"))
    return spark.read.format("lookups_by_id").option("path", f"{sf_dir}/documents.parquet").option("column", "doc_id").load().where("score > 20")


@CATALOG.query("SELECT page_id, md5(html) AS html_md5, page_id % 5 <> 0 AS ok FROM pages WHERE page_id % 5 <> 0 UNION ALL SELECT page_id, NULL, false FROM pages WHERE page_id % 5 = 0")
def fetched_pages(spark, sf_dir):
    """Pages by a caller's function: what can't be had is a row, not an error."""
    stored = table(spark, sf_dir, "pages").select(F.concat_ws("\u0001", F.col("page_id").cast("string"), "html").alias("url"))

    def get(url: str) -> str:
        name, _, html = url.partition("\u0001")
        if int(name) % 5 == 0:
            raise FileNotFoundError(name)
        return html

    rows = T.fetch_pages(stored, get, retries=0)
    return rows.select(F.substring_index("url", "\u0001", 1).cast("long").alias("page_id"), F.md5("html").alias("html_md5"), "ok")


@CATALOG.query("SELECT doc_id AS id, 'T ' || doc_id AS title, source AS summary, '2024-05-0' || (1 + doc_id % 9) AS published, 'A; ' || lang AS authors, 'cs.AR' AS categories FROM documents")
def atom_feed(spark, sf_dir):
    """Entries of stored feeds: white space in titles, several authors, namespaces."""
    i = F.col("doc_id").cast("string")
    entry = F.concat(
        F.lit("<entry><id>"), i, F.lit("</id><title>T \n  "), i, F.lit("</title><summary> "), "source", F.lit("</summary><published>2024-05-0"), (1 + F.col("doc_id") % 9).cast("string"),
        F.lit("T00:00:00Z</published><author><name>A</name></author><author><name>"), "lang", F.lit('</name></author><category term="cs.AR"/></entry>'),
    )
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:x="y">'), entry, F.lit("</feed>"))
    rows = T.parse_atom(table(spark, sf_dir, "documents").select(feed.alias("xml")))
    return rows.select(F.col("id").cast("long").alias("id"), "title", "summary", "published", F.array_join("authors", "; ").alias("authors"), F.array_join("categories", ",").alias("categories"))


@CATALOG.query("SELECT doc_id, 'dry_run' AS status, 'run --in ' || source || '/' || doc_id || '.json --lang ' || lang AS preview FROM documents")
def dry_run(spark, sf_dir):
    """Records of a run that calls nothing."""
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json"))
    jobs = table(spark, sf_dir, "documents").select("doc_id", F.array(F.lit("run"), F.lit("--in"), path, F.lit("--lang"), F.col("lang")).alias("command"))
    return stages.dry_run(jobs)

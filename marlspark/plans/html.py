"""Queries: fields of raw pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from .base import Catalog, table

CATALOG = Catalog()

_HEADING = "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"
# A listing page made of a page's id and heading, for both engines.
_LISTING = f"""'<ul><li class="x"></li><li class="entry inproceedings" id="conf/x/' || page_id || '"><a href="https://doi.org/10.1/' || page_id || '">d</a><span title="ctx_ver=Z&rft.atitle=' || url_encode({_HEADING}) || '+%21.&rft.au=First+A&rft.au=Second+B&rft.au=Third+C&rft.date=2024"></span></li><li class="entry article" id="j/y/' || page_id || '"><span title="ctx_ver=Z&rft.atitle=Bad%zz%20' || page_id || '%C3%A9%..&rft.au=Solo"></span></li><li class="entry article" id="none"></li></ul>'"""


@CATALOG.query("SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS heading, len(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS n_links FROM pages")
def html_title_links(spark, sf_dir):
    h = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", H.page_title(h).alias("title"), H.first_heading(h).alias("heading"), F.size(H.links(h)).cast("long").alias("n_links"))


@CATALOG.query(f"SELECT page_id, CAST(0 AS BIGINT) AS pos, 'doi:10.1/' || page_id AS paper_id, 'https://doi.org/10.1/' || page_id AS url, {_HEADING} || ' !' AS title, 'First A; Third C' AS authors FROM pages UNION ALL SELECT page_id, 1, 'dblp:j/y/' || page_id, 'https://dblp.org/rec/j/y/' || page_id, 'Bad%zz ' || page_id || 'é%', 'Solo' FROM pages")
def listing_entries(spark, sf_dir):
    """Entries with and without a DOI or metadata, bad escapes, trailing dots; every second of adjacent authors is read, as the pattern takes the next one's mark."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(_LISTING).alias("html"))
    rows = H.entries(pages)
    return rows.select("page_id", (F.col("pos") - 1).cast("long").alias("pos"), H.paper_id(F.col("doi"), F.col("key")).alias("paper_id"), H.paper_url(F.col("doi"), F.col("key")).alias("url"), "title", "authors")


# An index with volumes in many forms, one of them with a page's heading; and the same page as Spark and the oracle make it.
_INDEX = f"""'<a href="v2019">Volume 1, 2019</a> <A HREF="v2021">volume 2: 2021</A>' || chr(10) || '<a href="z">Issue 2022</a>' || chr(10) || '<a href="w2023">Vol. 12 2023</a>' || chr(10) || '<li><a href="b2024" class="c">' || {_HEADING} || ' Volume 13, <b>2024</b></a>' || chr(10) || '<a href="c2022">VOL14: 2022</a>' || chr(10) || '<a href="d2030">Volume 9 (2030)</a>'"""


@CATALOG.query(f"""
WITH h AS (SELECT page_id, {_INDEX} AS t FROM pages),
v AS (SELECT page_id, unnest(regexp_extract_all(t, '{H.VOLUME}', 1)) AS href, CAST(unnest(regexp_extract_all(t, '{H.VOLUME}', 2)) AS BIGINT) AS year, generate_subscripts(regexp_extract_all(t, '{H.VOLUME}', 1), 1) AS pos FROM h)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY year, pos) - 1 AS place, href, year FROM v WHERE year BETWEEN 2020 AND 2024""")
def volume_links(spark, sf_dir):
    """Volumes in several forms of writing, by year and then as they stand."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(_INDEX).alias("html"))
    return H.volumes(pages, 2020, 2024).select("page_id", F.col("place").cast("long").alias("place"), "href", F.col("year").cast("long").alias("year"))


@CATALOG.query("SELECT j, min(page_id) AS page_id, 'doi:10.1/' || d AS paper_id FROM (SELECT page_id, page_id % 3 AS j, page_id // 4 AS d FROM pages) GROUP BY j, d UNION ALL SELECT page_id % 3, page_id, 'dblp:j/' || page_id FROM pages")
def journal_dedup(spark, sf_dir):
    """A DOI that several volumes of a journal list counts once, in the first; entries without one all stay."""
    i = F.col("page_id")
    text = lambda c: c.cast("string")
    coins = '<span title="ctx_ver=Z&rft.atitle=T&rft.au=A&rft.date=1"></span>'
    listing = F.concat(F.lit('<li class="entry article" id="k"><a href="https://doi.org/10.1/'), text(F.floor(i / 4)), F.lit(f'">d</a>{coins}</li><li class="entry article" id="j/'), text(i), F.lit(f'">{coins}</li>'))
    rows = H.journal_entries(table(spark, sf_dir, "pages").select("page_id", (i % 3).alias("j"), listing.alias("html")), "j", "page_id")
    return rows.select("j", "page_id", H.paper_id(F.col("doi"), F.col("key")).alias("paper_id"))


@CATALOG.query("SELECT page_id, contains(lower(url), 'example') AS fits FROM pages")
def url_contains(spark, sf_dir):
    from ..functions.text import url_contains as has

    return table(spark, sf_dir, "pages").select("page_id", has(F.col("url"), "Example").alias("fits"))


@CATALOG.query(r"SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path, url_decode(regexp_extract(url, '\?([^#]*)', 1)) AS query FROM pages")
def url_parse(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(u, r"^https?://([^/?#]+)", 1).alias("host"), F.regexp_extract(u, r"^https?://[^/?#]+([^?#]*)", 1).alias("path"), H.unquoted(F.regexp_extract(u, r"\?([^#]*)", 1)).alias("query"))


@CATALOG.query("SELECT n_name AS id, y AS year, p AS part, 'https://dblp.org/db/conf/' || lower(n_name) || '/' || lower(n_name) || y || CASE p WHEN 0 THEN '' ELSE '-' || p END || '.html' AS url FROM nation, range(2022, 2025) t(y), range(0, 5) u(p)")
def page_candidates(spark, sf_dir):
    from ..sources.tables import page_candidates as candidates

    venues = table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"), F.concat(F.lit("conf/"), F.lower("n_name")).alias("key"), F.lower("n_name").alias("abbr"), F.explode(F.sequence(F.lit(2022), F.lit(2024))).alias("year"))
    return candidates(venues).select("id", F.col("year").cast("long").alias("year"), F.col("part").cast("long").alias("part"), "url")


@CATALOG.query("SELECT n_nationkey AS id, p AS part FROM nation, range(0, 5) u(p) WHERE CASE WHEN n_nationkey % 2 = 0 THEN p = 0 ELSE p BETWEEN 1 AND n_nationkey % 4 END")
def pages_until_gap(spark, sf_dir):
    """The plain page, else the suffixed ones before the first that is missing; later finds don't count."""
    from ..sources.tables import until_gap

    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("part"))
    ok = F.when(F.col("id") % 2 == 0, F.col("part") <= 1).otherwise(F.col("part").between(1, F.col("id") % 4) | (F.col("part") > F.col("id") % 4 + 1))
    return until_gap(nations.withColumn("ok", ok), ["id"]).select("id", F.col("part").cast("long").alias("part"))

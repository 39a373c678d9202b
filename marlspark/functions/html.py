"""Fields of raw listing pages: links, entries, embedded metadata, volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entries and volumes of listing pages.
ENTRY = r'<li\s[^>]*class="entry (?:inproceedings|article)"[^>]*id="([^"]+)"'
VOLUME = r'(?i)<a[^>]*href="([^"]+)"[^>]*>.*?(?:Volume|Vol\.?)\s*\d+.*?(\d{4})'


def unquoted(t: Column) -> Column:
    """Percent- and plus-decoded; an invalid escape stays as it is, and bytes that are no UTF-8 become U+FFFD."""
    parts = F.regexp_extract_all(F.replace(t, F.lit("+"), F.lit(" ")), F.lit(r"(?s)(?:%[0-9A-Fa-f]{2})+|[^%]+|%"), F.lit(0))
    decoded = lambda x: F.make_valid_utf8(F.unhex(F.replace(x, F.lit("%"), F.lit(""))).cast("string"))
    return F.array_join(F.transform(parts, lambda x: F.when(F.startswith(x, F.lit("%")) & (F.length(x) > 1), decoded(x)).otherwise(x)), "")


def first_heading(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]+)"'), F.lit(1))


# The patterns of a listing's DOI links and of its entries' metadata, as they stand here and in ``entries``.
def doi_link(html: Column) -> Column:
    return F.regexp_extract(html, r'href="https://doi\.org/([^"]+)"', 1)


def entries(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row for each listed paper that names a title: key, doi, title, authors, in page order."""
    block = F.split(F.col(html), r"(?=<li\s[^>]*class=\"entry (?:inproceedings|article)\")")
    rows = pages.drop("pos", "block").select("*", F.posexplode(block).alias("pos", "block")).where(F.col("block").rlike(ENTRY))
    coins = F.regexp_extract("block", r'title="(ctx_ver[^"]*rft\.atitle[^"]*)"', 1)
    rows = rows.withColumn("coins", coins)
    title = unquoted(F.regexp_extract("coins", r"(?d)rft\.atitle=(.+?)(?:&rft\.)", 1))
    authors = F.transform(F.regexp_extract_all("coins", F.lit(r"(?d)rft\.au=(.+?)(?:&rft\.|$)"), F.lit(1)), unquoted)
    return rows.select(
        *[c for c in pages.columns if c not in (html, "pos", "block")],
        "pos",
        F.regexp_extract("block", ENTRY, 1).alias("key"),
        doi_link(F.col("block")).alias("doi"),
        F.rtrim(title, F.lit(".")).alias("title"),
        F.array_join(authors, "; ").alias("authors"),
    ).where("title != ''")


def paper_id(doi: Column, key: Column) -> Column:
    return F.when(F.coalesce(doi, F.lit("")) != "", F.concat(F.lit("doi:"), doi)).otherwise(F.concat(F.lit("dblp:"), key))


def paper_url(doi: Column, key: Column) -> Column:
    return F.when(F.coalesce(doi, F.lit("")) != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.concat(F.lit("https://dblp.org/rec/"), key))


def volumes(pages: DataFrame, first: int, last: int, html: str = "html") -> DataFrame:
    """Volume links of a journal's index with years in range; ``place`` numbers them by year, then as they stand."""
    pattern = F.lit("(?d)" + VOLUME)
    kept = [c for c in pages.columns if c != html]
    found = F.arrays_zip(F.regexp_extract_all(html, pattern, F.lit(2)).cast("array<int>").alias("year"), F.regexp_extract_all(html, pattern, F.lit(1)).alias("href"))
    fits = F.filter(F.transform(found, lambda v, i: F.struct(v["year"].alias("year"), i.alias("pos"), v["href"].alias("href"))), lambda v: v["year"].between(first, last))
    return pages.select(*kept, F.posexplode(F.array_sort(fits)).alias("place", "v")).select(*kept, "place", "v.pos", "v.href", "v.year")


def journal_entries(pages: DataFrame, journal: str, place: str = "place", html: str = "html") -> DataFrame:
    """Entries of a journal's volumes; of those with one DOI only the first, by volume and place, stays."""
    from ..operators.dedup import first_by

    rows = entries(pages, html)
    blank = F.coalesce("doi", F.lit("")) == ""
    return rows.where(~blank).transform(first_by([journal, "doi"], place, "pos")).unionByName(rows.where(blank))

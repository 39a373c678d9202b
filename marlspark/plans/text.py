"""Queries: text functions, one or a few in each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from .base import Catalog, table

CATALOG = Catalog()

# SQL for the normalised text: look-around is spelled out, since the oracle's engine has none.
NORMAL = r"""trim(regexp_replace(regexp_replace(translate(replace(replace(replace(replace(replace(text, 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), '“”‘’ ', '""'''' '), '([\p{L}\p{N}_])-\s+([\p{L}\p{N}_])', '\1\2', 'g'), '\s+', ' ', 'g'))"""


@CATALOG.query("SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS spaced_md5, md5(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS squeezed_md5 FROM documents")
def normalize_title(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalized_title(F.col("text")).cast("binary")).alias("spaced_md5"), F.md5(X.squeezed(F.col("text")).cast("binary")).alias("squeezed_md5"))


@CATALOG.query(f"SELECT doc_id, md5({NORMAL}) AS text_md5 FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalized_text(F.col("text")).cast("binary")).alias("text_md5"))


@CATALOG.query(rf"SELECT doc_id, len(s) AS n_sentences, coalesce(list_max(list_transform(s, lambda x: length(x))), 0) AS longest FROM (SELECT doc_id, list_filter(string_split(regexp_replace({NORMAL}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') AS s FROM documents)")
def sentences(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select("doc_id", X.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0)).cast("long").alias("longest"))


@CATALOG.query(rf"SELECT doc_id, array_to_string(list_filter(list_transform(t, lambda x, i: CASE WHEN list_position(list_transform(t, lambda y: replace(replace(lower(y), '×', 'x'), ' ', '')), replace(replace(lower(x), '×', 'x'), ' ', '')) = i THEN x END), lambda x: x IS NOT NULL), '|') AS tokens FROM (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '{X.NUMERIC}'), lambda x: trim(x)), lambda x: NOT regexp_full_match(x, '\d')) AS t FROM documents)")
def numeric_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.numeric_tokens(F.col("text")), "|").alias("tokens"))


_NOISE = ("(?i)^(?:" + "|".join(X.NOISE) + ")").replace(r"\s", r"[\s\p{Z}]").replace(r"\d", r"\p{Nd}")
#: Boilerplate with spaces and digits that are not ASCII, before each text.
_BOILER = "2022\u00a0IEEE International Symposium on x\n\u0661\u0662\n"


@CATALOG.query(rf"SELECT doc_id, len(k) AS n_lines, md5(array_to_string(k, chr(10))) AS body_md5 FROM (SELECT doc_id, list_transform(list_filter(list_slice(l, 1, CASE WHEN p > 0 THEN p - 1 ELSE len(l) END), lambda x: trim(x) <> '' AND NOT regexp_matches(trim(x), '{_NOISE}')), lambda x: trim(x)) AS k FROM (SELECT doc_id, l, list_position(list_transform(l, lambda x: regexp_matches(trim(x), '{X.REFERENCES}')), true) AS p FROM (SELECT doc_id, string_split('{_BOILER}' || text, chr(10)) AS l FROM documents)))")
def clean_body_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", X.clean_lines(F.concat(F.lit(_BOILER), "text")).alias("k"))
    return lines.select("doc_id", F.size("k").cast("long").alias("n_lines"), F.md5(F.array_join("k", "\n").cast("binary")).alias("body_md5"))


@CATALOG.query("SELECT doc_id, regexp_matches(text, '[一-鿿]') AS has_cjk, length(text) AS chars, right(text, 40) AS tail, text[1:10] AS head FROM documents")
def text_measures(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.contains_cjk(t).alias("has_cjk"), F.length(t).cast("long").alias("chars"), X.tail(t, 40).alias("tail"), X.day(t).alias("head"))


@CATALOG.query(r"SELECT page_id, substr(regexp_replace(trim(regexp_replace(url, '[^\p{L}\p{N}_\s\-]', '', 'g')), '\s+', '-', 'g'), 1, 80) AS file_name, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_replace(url || CASE page_id % 4 WHEN 0 THEN '.review.json' WHEN 1 THEN '.revised.json' WHEN 2 THEN '.pdf' ELSE '.json' END, '(\.review\.json|\.revised\.json|\.json|\.pdf)$', '') AS stem FROM pages")
def file_names(spark, sf_dir):
    end = F.element_at(F.array(F.lit(".review.json"), F.lit(".revised.json"), F.lit(".pdf"), F.lit(".json")), (F.col("page_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", X.safe_filename(F.col("url")).alias("file_name"), X.slug(F.col("url")).alias("slug"), X.document_stem(F.concat("url", end)).alias("stem"))


@CATALOG.query(r"SELECT doc_id, lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '.' || lpad(CAST(doc_id AS VARCHAR), 5, '0') AS arxiv_id, '10.' || (1000 + doc_id % 9) AS prefix FROM documents")
def identifiers(spark, sf_dir):
    number = F.concat(F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"), F.lit("."), F.lpad(F.col("doc_id").cast("string"), 5, "0"))
    link = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://arxiv.org/abs/"), number, F.lit("v2"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("id:"), number)).otherwise(number)
    doi = F.concat(F.lit("10."), (1000 + F.col("doc_id") % 9).cast("string"), F.lit("/abc/"), "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", X.arxiv_id(link).alias("arxiv_id"), X.doi_prefix(doi).alias("prefix"))


@CATALOG.query("SELECT doc_id, md5(text) AS body_md5 FROM documents")
def strip_jats(spark, sf_dir):
    """Tags put around each text are stripped again."""
    t = F.concat(F.lit('<jats:p id="1">'), "text", F.lit("</jats:p>"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.strip_jats(t).cast("binary")).alias("body_md5"))

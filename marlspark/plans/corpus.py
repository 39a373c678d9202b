"""Queries: matching, catalogues and review state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import models as M
from ..operators import runs as R
from ..operators.dedup import last_by
from .base import Catalog, table

CATALOG = Catalog()
_SQUEEZED = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"


@CATALOG.query(f"""
WITH d AS (SELECT {_SQUEEZED.format('text')} AS t, min(doc_id) AS place, max(doc_id) AS doc_id FROM documents GROUP BY 1), b AS (SELECT item_id, {_SQUEEZED.format('text')} AS t FROM benchmark)
SELECT b.item_id, arg_min(d.doc_id, d.place) AS matched_doc_id FROM b LEFT JOIN d ON length(d.t) > 0 AND length(b.t) > 0 AND (contains(d.t, b.t) OR contains(b.t, d.t)) GROUP BY b.item_id""")
def containment_join(spark, sf_dir):
    """The first document that contains, or is contained in, each item; of documents alike the last one's values, in the first one's place."""
    return C.contained_first(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text", ["doc_id"]).select("item_id", "matched_doc_id")


@CATALOG.query("SELECT coalesce(CAST(d.doc_id AS VARCHAR), CAST(l.doc_id AS VARCHAR), CAST(b.item_id AS VARCHAR)) AS basename, d.source AS pdf, CAST(l.quality AS VARCHAR) AS revised, CAST(length(b.text) AS VARCHAR) AS human FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id FULL JOIN benchmark b ON b.item_id = coalesce(d.doc_id, l.doc_id)")
def catalog_full_outer(spark, sf_dir):
    part = lambda name, key, value: table(spark, sf_dir, name).select(F.col(key).cast("string").alias("basename"), value.alias("value"))
    return C.catalog(pdf=part("documents", "doc_id", F.col("source")), revised=part("labels", "doc_id", F.col("quality")), human=part("benchmark", "item_id", F.length("text")))


@CATALOG.query("""
WITH p AS (SELECT n_nationkey, s_suppkey, s_name, CASE WHEN s_nationkey = n_nationkey AND s_suppkey % 5 = 0 THEN 1 WHEN s_nationkey = n_nationkey THEN 2 WHEN s_suppkey % 25 = n_nationkey THEN 3 END AS rule FROM nation, supplier)
SELECT n_nationkey, CAST(rule AS BIGINT) AS rule, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY rule, s_suppkey) AS n FROM p WHERE rule IS NOT NULL) WHERE n = 1""")
def lookup_cascade(spark, sf_dir):
    """The item that fits the first rule of several."""
    rules = [(F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("s_suppkey") % 5 == 0), F.col("s_nationkey") == F.col("n_nationkey"), F.col("s_suppkey") % 25 == F.col("n_nationkey")]
    found = C.prioritized(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), "n_nationkey", rules, "s_suppkey", ["s_suppkey"])
    return found.select("n_nationkey", F.col("rule").cast("long").alias("rule"), "s_suppkey")


_DOSSIERS = "(SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN ' 10.1/D-  ' || (page_id // 2) ELSE '' END AS doi, CASE WHEN page_id % 90 = 7 THEN 'Popular' ELSE 'Deep-Learning on ' || (page_id % 90) END AS title, 'a/f-' || page_id || '.json' AS file, CASE WHEN page_id % 11 = 0 THEN 'given/' || page_id END AS named FROM pages)"
_SOURCES = "(SELECT CASE WHEN page_id % 2 = 0 THEN '10.1/D' ELSE '10.1/d' END || page_id AS doi, CASE WHEN page_id % 4 = 1 THEN 'popular!' ELSE 'DeepLearning: on' || page_id END AS title, 'b/F' || (page_id + 1) || '.json' AS file, 'p/' || page_id AS path FROM pages)"
_DOI = r"trim(regexp_replace(regexp_replace({}, '([\p{{L}}\p{{N}}_])-\s+([\p{{L}}\p{{N}}_])', '\1\2', 'g'), '\s+', ' ', 'g'))"
_STEM = r"regexp_replace(regexp_replace(regexp_extract({}, '[^/]*$'), '\.[^.]*$', ''), '[^A-Za-z0-9]', '', 'g')"


@CATALOG.query(f"""
WITH a AS {_DOSSIERS}, b AS {_SOURCES}, h AS (
  SELECT id, path, min(rule) AS rule FROM (
    SELECT a.id, b.path, 0 AS rule FROM a JOIN b ON {_DOI.format('a.doi')} = {_DOI.format('b.doi')} WHERE trim(a.doi) <> ''
    UNION ALL SELECT a.id, b.path, 1 FROM a JOIN b ON {_SQUEEZED.format('a.title')} = {_SQUEEZED.format('b.title')}
    UNION ALL SELECT a.id, b.path, 2 FROM a JOIN b ON lower({_STEM.format('a.file')}) = lower({_STEM.format('b.file')})) GROUP BY id, path),
g AS (SELECT id, count(*) AS n, min(path) AS path, min(rule) AS rule, array_to_string(list_sort(list(path))[1:5], ' ') AS options FROM h GROUP BY id)
SELECT a.id, CASE WHEN named IS NOT NULL OR g.n = 1 THEN 'resolved' WHEN g.n IS NULL THEN 'not_found' ELSE 'ambiguous' END AS status, coalesce(named, CASE WHEN g.n = 1 THEN g.path END) AS path,
  CASE WHEN named IS NOT NULL THEN 'explicit_path' WHEN g.n = 1 THEN ['doi', 'title_exact', 'filename_exact'][g.rule + 1] END AS resolved_by, CASE WHEN named IS NULL AND g.n > 1 THEN g.options END AS options FROM a LEFT JOIN g USING (id)""")
def source_resolution(spark, sf_dir):
    """Titles with joined words, a title that a quarter of all share, DOIs whose case counts, files told by their stems, paths that are given."""
    i = F.col("page_id")
    text = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in c])
    pages = table(spark, sf_dir, "pages")
    dossiers = pages.select(i.alias("id"), F.when(i % 3 == 0, text(" 10.1/D-  ", F.floor(i / 2))).otherwise("").alias("doi"), F.when(i % 90 == 7, "Popular").otherwise(text("Deep-Learning on ", i % 90)).alias("title"), text("a/f-", i, ".json").alias("file"), F.when(i % 11 == 0, text("given/", i)).alias("named"))
    papers = pages.select(text(F.when(i % 2 == 0, "10.1/D").otherwise("10.1/d"), i).alias("doi"), F.when(i % 4 == 1, "popular!").otherwise(text("DeepLearning: on", i)).alias("title"), text("b/F", i + 1, ".json").alias("file"), text("p/", i).alias("path"))
    return C.resolve(dossiers, papers, "id", "named").withColumn("options", F.array_join("options", " "))


_MODELS = """(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'A' || doc_id END ELSE CASE WHEN doc_id % 3 = 0 THEN 'R' || doc_id END END AS t1, CASE WHEN doc_id % 2 = 0 THEN 'a' WHEN doc_id % 3 = 0 THEN 'r' END AS v1,
  CASE WHEN doc_id % 5 = 0 THEN 'B' || doc_id WHEN doc_id % 7 = 0 THEN '' END AS t2, CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN 'b' END AS v2, CASE WHEN doc_id % 3 = 0 THEN 'R' || doc_id END AS revised FROM documents)"""


@CATALOG.query(f"SELECT doc_id, coalesce(nullif(t1, ''), nullif(t2, ''), CASE WHEN v2 IS NOT NULL THEN t2 ELSE t1 END) AS title, CASE WHEN coalesce(t1, '') <> '' THEN v1 WHEN coalesce(t2, '') <> '' THEN v2 ELSE coalesce(v2, v1) END AS venue, CASE WHEN revised IS NOT NULL THEN CASE WHEN doc_id % 5 = 0 THEN 'human' ELSE revised END END AS shown FROM {_MODELS}")
def metadata_coalesce(spark, sf_dir):
    """The first model with a title, else the last one's record; a model's revised file counts only where it has no raw one, not where that has no title.

    A human document replaces a revised one whole.
    """
    i = F.col("doc_id")
    record = lambda title, venue: F.struct(title.alias("title"), F.lit(venue).alias("venue"))
    named = lambda prefix: F.concat(F.lit(prefix), i.cast("string"))
    raw, revised = record(F.when(i % 4 == 0, "").otherwise(named("A")), "a"), F.when(i % 3 == 0, record(named("R"), "r"))
    second = F.when(i % 5 == 0, record(named("B"), "b")).when(i % 7 == 0, record(F.lit(""), "b"))
    docs = table(spark, sf_dir, "documents").select("doc_id", C.model_record(i % 2 == 0, raw, revised).alias("m1"), second.alias("m2"), revised.alias("revised"), F.when(i % 5 == 0, record(F.lit("human"), "h")).alias("human"))
    best = C.first_titled(F.col("m1"), F.col("m2"))
    return docs.select("doc_id", best["title"].alias("title"), best["venue"].alias("venue"), C.overlay(F.col("human"), F.col("revised"))["title"].alias("shown"))


_PAIRS = "(SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Paper, ' WHEN 1 THEN 'paper ' WHEN 2 THEN 'Pa-  per,  ' ELSE ' Paper, ' END || page_id AS a_title, 'Paper, ' || (page_id - page_id % 2 * (page_id % 3)) AS p_title, 'Ann Bo' AS a_authors, CASE page_id % 3 WHEN 0 THEN 'Ann Bo; Cy' WHEN 1 THEN 'ann bo' ELSE NULL END AS p_authors, 2000 + page_id % 3 AS a_year, 2001 AS p_year, CASE WHEN page_id % 2 = 0 THEN 'V' END AS a_venue, CASE WHEN page_id % 4 = 0 THEN 'V' ELSE '' END AS p_venue, 'D' AS a_doi, CASE WHEN page_id % 5 = 0 THEN 'd' ELSE 'D' END AS p_doi FROM pages)"
_CHECKS = f"""(SELECT page_id, field, CASE WHEN same THEN 'pass' WHEN field = 'authors' AND a <> '' AND p <> '' AND (contains(a, p) OR contains(p, a)) THEN 'partial' ELSE 'fail' END AS status FROM (
  SELECT page_id, field, {_DOI.format("coalesce(a, '')")} AS a, {_DOI.format("coalesce(p, '')")} AS p, CASE WHEN field = 'year' THEN a = p ELSE {_DOI.format("coalesce(a, '')")} = {_DOI.format("coalesce(p, '')")} END AS same
  FROM (SELECT page_id, unnest(['title', 'authors', 'year', 'venue', 'doi']) AS field, unnest([a_title, a_authors, CAST(a_year AS VARCHAR), a_venue, a_doi]) AS a, unnest([p_title, p_authors, CAST(p_year AS VARCHAR), p_venue, p_doi]) AS p FROM {_PAIRS})))"""


def _checks(spark, sf_dir):
    i = F.col("page_id")
    text = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in c])
    start = F.element_at(F.array(*map(F.lit, ("Paper, ", "paper ", "Pa-  per,  ", " Paper, "))), (i % 4 + 1).cast("int"))
    pairs = table(spark, sf_dir, "pages").select(
        "page_id", text(start, i).alias("a_title"), text("Paper, ", i - i % 2 * (i % 3)).alias("p_title"), F.lit("Ann Bo").alias("a_authors"), F.when(i % 3 == 0, "Ann Bo; Cy").when(i % 3 == 1, "ann bo").alias("p_authors"),
        (2000 + i % 3).alias("a_year"), F.lit(2001).alias("p_year"), F.when(i % 2 == 0, "V").alias("a_venue"), F.when(i % 4 == 0, "V").otherwise("").alias("p_venue"), F.lit("D").alias("a_doi"), F.when(i % 5 == 0, "d").otherwise("D").alias("p_doi"),
    )
    return C.compare_metadata(pairs, "page_id")


@CATALOG.query(f"SELECT page_id, field, status, CASE WHEN status = 'fail' THEN CASE WHEN field IN ('title', 'year') THEN 'critical' ELSE 'major' END END AS severity FROM {_CHECKS}")
def metadata_compare(spark, sf_dir):
    """Case and punctuation count, hyphens at line ends and runs of spaces do not; null is blank."""
    return _checks(spark, sf_dir).select("page_id", "field", "status", "severity")


@CATALOG.query(f"SELECT page_id, CASE WHEN count(*) FILTER (field IN ('title', 'year')) > 0 THEN 'fail' ELSE 'mixed' END AS status, count(*) AS issue_count, count(*) FILTER (field IN ('title', 'year')) AS critical_count, count(*) FILTER (field NOT IN ('title', 'year')) AS major_count, CAST(0 AS BIGINT) AS minor_count FROM {_CHECKS} WHERE status = 'fail' GROUP BY page_id")
def metadata_issues(spark, sf_dir):
    """Differences as issues, rolled up like all others."""
    return R.rollup_status(C.metadata_issues(_checks(spark, sf_dir), "page_id"), ["page_id"])


_BODY = "CASE WHEN d.doc_id % 9 = 0 THEN '' WHEN d.doc_id % 9 = 1 THEN rpad('x', 199 + CAST(d.doc_id % 2 AS INT), 'y') ELSE d.text END"
_DRAFTS = f"(SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality, CASE WHEN l.doc_id % 3 = 0 THEN 2024 ELSE 0 END AS year, {_BODY} AS body_text, l.doc_id IS NOT NULL AS csv_matched FROM documents d LEFT JOIN labels l USING (doc_id))"


def _drafts(spark, sf_dir):
    i = F.col("doc_id")
    body = F.when(i % 9 == 0, "").when(i % 9 == 1, F.rpad(F.lit("x"), (199 + i % 2).cast("int"), F.lit("y"))).otherwise(F.col("text"))
    index = table(spark, sf_dir, "labels").select("doc_id", "quality", F.when(i % 3 == 0, "2024").otherwise("").alias("year"))
    return C.drafts(table(spark, sf_dir, "documents").select("doc_id", body.alias("body_text")), index, "doc_id", ["quality", "year"])


@CATALOG.query(f"SELECT doc_id, quality, year, length(body_text) AS text_length, csv_matched, CASE WHEN length(body_text) >= 200 THEN 'success' ELSE 'failed' END AS extraction_status FROM {_DRAFTS}")
def draft_assembly(spark, sf_dir):
    """Texts of 199 and of 200 characters, the least that is a success."""
    return _drafts(spark, sf_dir).select("doc_id", "quality", "year", "text_length", "csv_matched", "extraction_status")


@CATALOG.query(f"SELECT count(*) AS total, count(*) FILTER (csv_matched AND length(body_text) >= 200) AS success, count(*) FILTER (csv_matched AND length(body_text) < 200) AS failed, count(*) FILTER (NOT csv_matched) AS no_csv_match FROM {_DRAFTS}")
def extraction_summary(spark, sf_dir):
    return C.extraction_summary(_drafts(spark, sf_dir))


_KEEP = "CASE doc_id % 6 WHEN 0 THEN ' Keep ' WHEN 1 THEN 'core' WHEN 2 THEN 'related' WHEN 3 THEN 'skip' ELSE ' ' END"


def _marked(spark, sf_dir):
    i = F.col("doc_id")
    keep = F.when(i % 6 == 0, " Keep ").when(i % 6 == 1, "core").when(i % 6 == 2, "related").when(i % 6 == 3, "skip").otherwise(" ")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", keep.alias("keep"), F.when(i % 4 == 0, "").otherwise(F.concat(F.lit("10.1/"), i.cast("string"))).alias("doi"))


@CATALOG.query(f"SELECT 'https://doi.org/10.1/' || doc_id AS value FROM documents WHERE lower(trim({_KEEP})) = 'keep' AND doc_id % 4 <> 0")
def tag_export(spark, sf_dir):
    return C.doi_lines(C.tagged(_marked(spark, sf_dir), "keep"))


@CATALOG.query(f"SELECT lower(trim({_KEEP})) AS tag, count(*) FILTER (doc_id % 4 <> 0) AS with_doi, count(*) FILTER (doc_id % 4 = 0) AS without_doi FROM documents WHERE lower(trim({_KEEP})) IN ('keep', 'core', 'related') GROUP BY 1")
def tag_split(spark, sf_dir):
    rows = C.tagged(_marked(spark, sf_dir), "keep", "core", "related")
    return rows.groupBy(F.lower(F.trim("keep")).alias("tag")).agg(F.count_if(F.col("doi") != "").alias("with_doi"), F.count_if(F.col("doi") == "").alias("without_doi"))


@CATALOG.query(f"SELECT count(*) FILTER (trim({_KEEP}) <> '') AS reviewed, count(*) AS total, CAST(ceil(count(*) / 4.0) AS BIGINT) AS pages FROM documents")
def review_progress(spark, sf_dir):
    return C.progress(_marked(spark, sf_dir))


@CATALOG.query("SELECT doc_id FROM documents WHERE contains(lower(lang || ' ' || source), 'en src1')")
def free_text_search(spark, sf_dir):
    return C.search(_marked(spark, sf_dir), "EN src1", "lang", "source").select("doc_id")


@CATALOG.query("SELECT count(*) FILTER (l.quality = 1) AS downloaded, count(*) FILTER (l.doc_id IS NULL) AS not_found, count(*) FILTER (l.quality = 0) AS no_pdf FROM documents d LEFT JOIN labels l USING (doc_id)")
def sync_counters(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.agg(F.count_if(F.col("quality") == 1).alias("downloaded"), F.count_if(F.col("quality").isNull()).alias("not_found"), F.count_if(F.col("quality") == 0).alias("no_pdf"))


@CATALOG.query("SELECT doc_id, row_number() OVER w AS place, (row_number() OVER w - 1) // 4 AS page, lag(doc_id) OVER w AS previous, lead(doc_id) OVER w AS next FROM documents WINDOW w AS (PARTITION BY source ORDER BY n_chars DESC, doc_id)")
def review_navigation(spark, sf_dir):
    """Place, page, and the records before and after each in review order."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", (-F.col("n_chars")).alias("less"))
    return C.neighbours(rows, ["source"], "doc_id", "less", "doc_id").select("doc_id", "place", "page", "previous", "next")


@CATALOG.query("SELECT doc_id, row_number() OVER w AS place, (row_number() OVER w - 1) // 4 AS page, lag(doc_id) OVER w AS previous, lead(doc_id) OVER w AS next FROM documents WINDOW w AS (ORDER BY n_chars DESC, doc_id)")
def review_order(spark, sf_dir):
    """The same over the whole table, which no task holds."""
    rows = table(spark, sf_dir, "documents").select("doc_id", (-F.col("n_chars")).alias("less"))
    return C.neighbours(rows, [], "doc_id", "less", "doc_id").select("doc_id", "place", "page", "previous", "next")


@CATALOG.query("SELECT doc_id AS basename, quality AS revised FROM documents JOIN labels USING (doc_id)")
def catalog_listed(spark, sf_dir):
    """Of a catalogue, what has a model."""
    part = lambda name, value: table(spark, sf_dir, name).select(F.col("doc_id").cast("string").alias("basename"), value.alias("value"))
    rows = C.listed(C.catalog(pdf=part("documents", F.col("source")), revised=part("labels", F.col("quality"))).where("pdf is not null"), "revised")
    return rows.select(F.col("basename").cast("long").alias("basename"), F.col("revised").cast("long").alias("revised"))


@CATALOG.query("SELECT conv_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def human_document_latest(spark, sf_dir):
    """A whole-document edit replaces all before it."""
    return table(spark, sf_dir, "conversations").transform(last_by("conv_id", "turn")).select("conv_id", "text")


_FILES = """
(SELECT 'pdf' AS area, NULL AS model, 'd' || doc_id || CASE WHEN doc_id % 9 = 0 THEN '.txt' ELSE '.pdf' END AS file FROM documents
UNION ALL SELECT 'llm', 'glm5.1', 'd' || doc_id || CASE WHEN quality = 1 THEN '.json' ELSE '.review.json' END FROM labels
UNION ALL SELECT 'llm', 'gpt5.4', 'd' || page_id || CASE WHEN page_id % 4 = 0 THEN '.json' ELSE '.revised.json' END FROM pages
UNION ALL SELECT 'llm', 'other', 'e' || item_id || '.json' FROM benchmark
UNION ALL SELECT 'human', NULL, 'd' || item_id || '.json' FROM benchmark)"""
_CATALOG = f"""
WITH f AS (SELECT *, regexp_replace(file, '([.]review[.]json|[.]revised[.]json|[.]json|[.]pdf)$', '') AS basename FROM {_FILES} WHERE file NOT LIKE '%.txt'),
c AS (
  SELECT basename, max(file) FILTER (area = 'pdf') AS pdf, max(file) FILTER (area = 'human') AS human, count(DISTINCT model) AS n_models,
    max(file) FILTER (model = 'glm5.1' AND file NOT LIKE '%.review.json') AS glm_raw, max(file) FILTER (model = 'glm5.1' AND file LIKE '%.review.json') AS glm_review,
    max(file) FILTER (model = 'gpt5.4' AND file NOT LIKE '%.revised.json') AS gpt_raw, max(file) FILTER (model = 'gpt5.4' AND file LIKE '%.revised.json') AS gpt_revised
  FROM f GROUP BY basename HAVING count(model) > 0
)"""


def _files(spark, sf_dir):
    def listing(name, area, model, key, suffix, prefix="d"):
        return table(spark, sf_dir, name).select(F.lit(area).alias("area"), F.lit(model).cast("string").alias("model"), F.concat(F.lit(prefix), F.col(key).cast("string"), suffix).alias("file"))

    return (
        listing("documents", "pdf", None, "doc_id", F.when(F.col("doc_id") % 9 == 0, ".txt").otherwise(".pdf"))
        .unionByName(listing("labels", "llm", "glm5.1", "doc_id", F.when(F.col("quality") == 1, ".json").otherwise(".review.json")))
        .unionByName(listing("pages", "llm", "gpt5.4", "page_id", F.when(F.col("page_id") % 4 == 0, ".json").otherwise(".revised.json")))
        .unionByName(listing("benchmark", "llm", "other", "item_id", F.lit(".json"), "e"))
        .unionByName(listing("benchmark", "human", None, "item_id", F.lit(".json")))
    )


@CATALOG.query(_CATALOG + " SELECT * FROM c")
def model_catalog(spark, sf_dir):
    """Papers of any model, with the files of each as a map, told from a listing of files."""
    m = lambda name, kind: F.col("models")[name][kind]
    return M.model_catalog(_files(spark, sf_dir)).select("basename", "pdf", "human", F.size("models").cast("long").alias("n_models"), m("glm5.1", "raw").alias("glm_raw"), m("glm5.1", "review").alias("glm_review"), m("gpt5.4", "raw").alias("gpt_raw"), m("gpt5.4", "revised").alias("gpt_revised"))


@CATALOG.query(_CATALOG + """,
d AS (
  SELECT 'd' || doc_id || '.json' AS file, max(CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'glm ' || doc_id END) AS title, bool_and(doc_id % 6 <> 5) AS sound FROM labels WHERE doc_id % 8 <> 7 GROUP BY doc_id
), g AS (SELECT 'd' || page_id || CASE WHEN page_id % 4 = 0 THEN '.json' ELSE '.revised.json' END AS file, CASE WHEN page_id % 5 = 0 THEN '' ELSE 'gpt ' || page_id END AS title FROM pages),
m AS (SELECT c.basename, d.file AS a, coalesce(d.title, '') AS ta, coalesce(d.sound, false) AS sound, g.file AS b, g.title AS tb FROM c LEFT JOIN d ON d.file = c.glm_raw LEFT JOIN g ON g.file = coalesce(c.gpt_raw, c.gpt_revised))
SELECT basename, CASE WHEN sound AND ta <> '' THEN ta WHEN b IS NOT NULL THEN tb WHEN sound THEN ta END AS title, CASE WHEN sound AND ta <> '' THEN 'a' WHEN b IS NOT NULL THEN 'b' WHEN sound THEN 'a' END AS venue, CASE WHEN sound AND ta <> '' THEN '2024' WHEN b IS NOT NULL THEN '' WHEN sound THEN '2024' END AS year FROM m""")
def model_metadata(spark, sf_dir):
    """Titles, venues and years from the first model that has a title; documents may be absent, broken, or without fields."""
    i, j = F.col("doc_id"), F.col("page_id")
    first = F.to_json(F.struct(F.when(i % 4 == 0, "").when(i % 4 != 1, F.concat(F.lit("glm "), i.cast("string"))).alias("title"), F.lit("a").alias("venue"), F.lit(2024).alias("year")))
    one = table(spark, sf_dir, "labels").where(i % 8 != 7).select(F.lit("glm5.1").alias("model"), F.concat(F.lit("d"), i.cast("string"), F.lit(".json")).alias("file"), F.when(i % 6 == 5, F.lit("{broken")).otherwise(first).alias("text"))
    second = F.to_json(F.struct(F.when(j % 5 == 0, "").otherwise(F.concat(F.lit("gpt "), j.cast("string"))).alias("title"), F.lit("b").alias("venue")))
    two = table(spark, sf_dir, "pages").select(F.lit("gpt5.4").alias("model"), F.concat(F.lit("d"), j.cast("string"), F.when(j % 4 == 0, ".json").otherwise(".revised.json")).alias("file"), second.alias("text"))
    return M.model_metadata(M.model_catalog(_files(spark, sf_dir)), one.unionByName(two)).select("basename", "title", "venue", "year")

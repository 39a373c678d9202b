"""Queries: checks of analyses made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import containment as H
from ..operators import json_rules as J
from ..operators import preflight as P
from ..operators import runs as R
from .base import Catalog, table
from .text import NORMAL

CATALOG = Catalog()


@CATALOG.query("SELECT event_id, k AS field, CASE json_type(props, '$.' || k) WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'float' ELSE 'missing' END AS kind FROM events, (VALUES ('k'), ('page'), ('nope')) t(k)")
def schema_check(spark, sf_dir):
    """Types of JSON fields, missing and null told apart."""
    v = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return v.select("event_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), P.kind_of(P.get(F.col("v"), f)).alias("kind")) for f in ("k", "page", "nope")])).alias("x")).select("event_id", "x.*")


def _dossier(i):
    """An analysis of some shape for each number: whole ones, and ones with each kind of fault."""
    point = '{"point": "p", "evidence": "e"}'
    gap = '{"gap": "g", "evidence": "e", "relevance_to_cute": "r"}'
    base = F.concat(
        F.lit('{"title": "T", "authors": "A", "year": '), F.when(i % 4 == 1, '"2024"').when(i % 4 == 2, "true").otherwise("2024"),
        F.lit(', "venue": "V", "doi": "D", "research_purpose": "'), F.when(i % 6 == 1, 'a \\"b\\"').otherwise("a"),
        F.lit('", "research_significance": "s", "contributions": '), F.when(i % 5 == 0, f"[{point}]").when(i % 5 == 1, "null").when(i % 5 == 2, f'[{point}, 7]').when(i % 5 == 3, f'[{point}, {{"point": "p", "evidence": "中"}}]').otherwise(f"[{point}, {point}]"),
        F.lit(', "theme_primary": "'), F.when(i % 3 == 0, P.THEMES[0]).otherwise("1. CPU"), F.lit('", "theme_secondary": '), F.when(i % 7 == 0, "3").when(i % 7 == 1, '""').otherwise("null"),
        F.lit(', "workstream_fit": "'), (i % 5).cast("string"), F.lit('", "is_close_baseline_to_cute": false, "key_technique": "k"'), F.when(i % 8 == 0, "").otherwise(', "key_results": "10x in 3 ms"'),
        F.lit(f', "gap_identified": [{gap}], "proposal_evidence": {{"for_state_of_art": "x", "for_gap": '), F.when(i % 9 == 0, "1").otherwise('"y"'), F.lit(', "for_feasibility": "z"}}'),
    )
    return F.try_parse_json(F.regexp_replace(base, r"\}\}$", "}}"))


_SEVERITIES = """(
  SELECT page_id, 'critical' AS severity, 'schema' AS category FROM pages WHERE page_id % 4 = 1
  UNION ALL SELECT page_id, 'minor', 'format' FROM pages WHERE page_id % 6 = 1
  UNION ALL SELECT page_id, 'major', 'schema' FROM pages WHERE page_id % 5 = 0
  UNION ALL SELECT page_id, 'critical', 'schema' FROM pages WHERE page_id % 5 IN (1, 2)
  UNION ALL SELECT page_id, 'major', 'format' FROM pages WHERE page_id % 5 = 3
  UNION ALL SELECT page_id, 'major', 'taxonomy' FROM pages WHERE page_id % 3 <> 0
  UNION ALL SELECT page_id, 'critical', 'schema' FROM pages WHERE page_id % 7 = 0
  UNION ALL SELECT page_id, 'major', 'taxonomy' FROM pages WHERE page_id % 7 = 1
  UNION ALL SELECT page_id, 'major', 'taxonomy' FROM pages WHERE page_id % 5 IN (0, 4)
  UNION ALL SELECT page_id, 'critical', 'schema' FROM pages WHERE page_id % 8 = 0
  UNION ALL SELECT page_id, 'critical', 'schema' FROM pages WHERE page_id % 9 = 0)"""


def _issues(spark, sf_dir):
    v = table(spark, sf_dir, "pages").select("page_id", _dossier(F.col("page_id")).alias("v"))
    return v.select("page_id", P.schema_issues(F.col("v")).alias("issues"))


@CATALOG.query(f"SELECT page_id, category, severity, count(*) AS n FROM {_SEVERITIES} GROUP BY ALL")
def issue_counts(spark, sf_dir):
    rows = _issues(spark, sf_dir).select("page_id", F.explode("issues").alias("i")).select("page_id", "i.*")
    return rows.groupBy("page_id", "category", "severity").agg(F.count("*").alias("n"))


@CATALOG.query(f"SELECT p.page_id, CASE WHEN count(*) FILTER (severity = 'critical') > 0 THEN 'fail' WHEN count(severity) > 0 THEN 'mixed' ELSE 'pass' END AS status, count(severity) AS issue_count, count(*) FILTER (severity = 'critical') AS critical_count, count(*) FILTER (severity = 'major') AS major_count, count(*) FILTER (severity = 'minor') AS minor_count FROM pages p LEFT JOIN {_SEVERITIES} s USING (page_id) GROUP BY p.page_id")
def status_rollup(spark, sf_dir):
    rows = _issues(spark, sf_dir).select("page_id", F.explode_outer("issues").alias("i")).select("page_id", "i.severity")
    return R.rollup_status(rows, ["page_id"])


@CATALOG.query("SELECT event_type, CASE WHEN bool_or(value > 99) THEN 'fail' WHEN count(*) FILTER (value > 50) > 0 THEN 'mixed' ELSE 'pass' END AS status, count(*) FILTER (value > 50) AS issue_count, count(*) FILTER (value > 99) AS critical_count, count(*) FILTER (value > 90 AND value <= 99) AS major_count, count(*) FILTER (value > 50 AND value <= 90) AS minor_count FROM events GROUP BY event_type")
def event_rollup(spark, sf_dir):
    v = F.col("value")
    rows = table(spark, sf_dir, "events").select("event_type", F.when(v > 99, "critical").when(v > 90, "major").when(v > 50, "minor").alias("severity"))
    return R.rollup_status(rows, ["event_type"])


@CATALOG.query(f"SELECT b.item_id, count(*) AS n, min(d.doc_id) AS first_doc FROM (SELECT item_id, lower({NORMAL}) AS q FROM benchmark) b JOIN (SELECT doc_id, lower({NORMAL}) AS t FROM documents) d ON contains(d.t, b.q) GROUP BY b.item_id")
def evidence_exact(spark, sf_dir):
    quotes = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("q"))
    bodies = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("t"))
    return H.containing(quotes, bodies, "q", "t", H.NORMAL).groupBy("item_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@CATALOG.query()
def evidence_fuzzy(spark, sf_dir):
    """Quotes drawn from anywhere in each document against the whole of it; difflib has no SQL."""
    docs = table(spark, sf_dir, "documents")
    room = F.greatest(F.length("text") - 60, F.lit(0)) + 1  # places where a quote of 60 characters can start
    at = (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % room + 1).cast("int")
    drawn = lambda n: F.substring("text", at, F.lit(n))
    changed = F.concat(F.regexp_replace(drawn(60), "e", "e "), F.lit("."))
    pairs = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, drawn(50)).when(F.col("doc_id") % 3 == 1, changed).otherwise("").alias("quote"), F.col("text").alias("body"))
    return P.check_quotes(pairs).select("doc_id", "status", "severity", "ratio")


@CATALOG.query(rf"""
WITH c AS (SELECT doc_id, unnest(['10x', '3 ms', '42 %']) AS token, replace(replace(lower({NORMAL}), '×', 'x'), ' ', '') AS s FROM documents)
SELECT doc_id, count(*) FILTER (contains(s, replace(token, ' ', ''))) AS matched, count(*) AS total FROM c GROUP BY doc_id""")
def numeric_claims(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select("doc_id", F.lit("was 10x in 3 ms, 42 % and 10X again, 7").alias("claim"), F.col("text").alias("body"))
    return P.totals(P.check_numbers(pairs, "claim", "body"), "doc_id")


@CATALOG.query("SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN '{\"a\": ' || (doc_id % 4) || ', \"b\": {\"c\": \"x}\"}}' END AS found FROM documents")
def embedded_json(spark, sf_dir):
    """The first JSON object within other text."""
    from ..functions.jsons import first_object

    i = F.col("doc_id") % 4
    good = F.concat(F.lit("note {bad} then "), F.concat(F.lit('{"a": '), i.cast("string"), F.lit(', "b": {"c": "x}"}}')), F.lit(' tail {"z": 1}'))
    texts = table(spark, sf_dir, "documents").select("doc_id", F.when(i < 3, good).otherwise("no { object ] here").alias("text"))
    return first_object(texts, "text", "found").select("doc_id", "found")


_ANSWER = """('{"verdict": ' || CASE page_id % 5 WHEN 0 THEN '"pass"' WHEN 1 THEN '"maybe"' WHEN 2 THEN 'null' WHEN 3 THEN '7' ELSE '"fail"' END || CASE WHEN page_id % 4 = 1 THEN '' ELSE ', "count": ' || CASE page_id % 4 WHEN 0 THEN '3' WHEN 2 THEN '2.5' ELSE '"3"' END END
  || ', "notes": [' || CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '"a", 1' ELSE '"a"' END || ']' || CASE WHEN page_id % 7 = 0 THEN ', "extra": {}' ELSE '' END || ', "theme": ' || CASE page_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '"x"' ELSE '"z"' END || CASE WHEN page_id % 11 = 0 THEN '' ELSE '}' END)"""


@CATALOG.query(f"""
WITH j AS (SELECT page_id, {_ANSWER} AS t FROM pages), v AS (SELECT page_id, CASE WHEN json_valid(t) THEN t END AS t FROM j)
SELECT page_id, '$' AS path, 'json' AS rule FROM v WHERE t IS NULL
UNION ALL SELECT page_id, '$.verdict', CASE WHEN json_type(t, '$.verdict') <> 'VARCHAR' THEN 'type' ELSE 'enum' END FROM v WHERE json_type(t, '$.verdict') <> 'VARCHAR' OR json_extract_string(t, '$.verdict') NOT IN ('pass', 'fail')
UNION ALL SELECT page_id, '$.count', CASE WHEN json_type(t, '$.count') IS NULL THEN 'required' ELSE 'type' END FROM v WHERE t IS NOT NULL AND coalesce(json_type(t, '$.count'), '') NOT IN ('UBIGINT', 'BIGINT')
UNION ALL SELECT page_id, '$.notes', 'minItems' FROM v WHERE json_array_length(t, '$.notes') < 1
UNION ALL SELECT page_id, '$.notes[' || i || ']', 'type' FROM (SELECT page_id, t, unnest(range(CAST(json_array_length(t, '$.notes') AS BIGINT))) AS i FROM v) WHERE json_type(t, '$.notes[' || i || ']') <> 'VARCHAR'
UNION ALL SELECT page_id, '$.' || k, 'additionalProperties' FROM (SELECT page_id, unnest(json_keys(t)) AS k FROM v) WHERE k NOT IN ('verdict', 'count', 'notes', 'theme')
UNION ALL SELECT page_id, '$.theme', 'anyOf' FROM v WHERE json_type(t, '$.theme') <> 'NULL' AND json_extract_string(t, '$.theme') NOT IN ('x', 'y')""")
def schema_rules(spark, sf_dir):
    """Answers against a JSON Schema: enumerations, whole numbers, lists, names that lack or are foreign, null or one of a list, and text that is no JSON."""
    rules = J.Rules(J.closed(verdict=J.one_of("pass", "fail"), count={"type": "integer"}, notes=J.list_of({"type": "string"}, 1), theme={"anyOf": [J.one_of("x", "y"), {"type": "null"}]}))
    i = F.col("page_id")
    pick = lambda n, *options: F.element_at(F.array(*map(F.lit, options)), (i % n + 1).cast("int"))
    count = F.when(i % 4 == 1, "").otherwise(F.concat(F.lit(', "count": '), pick(4, "3", "", "2.5", '"3"')))
    text = F.concat(F.lit('{"verdict": '), pick(5, '"pass"', '"maybe"', "null", "7", '"fail"'), count, F.lit(', "notes": ['), pick(3, "", '"a", 1', '"a"'), F.lit("]"), F.when(i % 7 == 0, ', "extra": {}').otherwise(""), F.lit(', "theme": '), pick(3, "null", '"x"', '"z"'), F.when(i % 11 == 0, "").otherwise("}"))
    answers = table(spark, sf_dir, "pages").select("page_id", F.try_parse_json(text).alias("v"))
    return answers.select("page_id", F.explode(rules.issues(F.col("v"))).alias("x")).select("page_id", "x.path", "x.rule")


@CATALOG.query("SELECT doc_id, 'ok' || (doc_id % 3) AS verdict, 'T' || doc_id AS title FROM documents")
def bundle_split(spark, sf_dir):
    """A bundle's review and revised parts, by a fixed schema."""
    from ..functions.jsons import split_bundle

    i = F.col("doc_id")
    bundle = F.to_json(F.struct(F.struct(F.concat(F.lit("ok"), (i % 3).cast("string")).alias("overall_verdict")).alias("review"), F.struct(F.concat(F.lit("T"), i.cast("string")).alias("title")).alias("revised")))
    parts = split_bundle(table(spark, sf_dir, "documents").select("doc_id", bundle.alias("bundle")), "bundle")
    return parts.select("doc_id", F.col("review.overall_verdict").alias("verdict"), F.col("revised.title").alias("title"))

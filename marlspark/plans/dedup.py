"""Queries: first and last rows for each key, unions, membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup as D
from .base import Catalog, table

CATALOG = Catalog()


@CATALOG.query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def first_wins_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", X.normalized_title(F.col("text")).alias("key"))
    return docs.transform(D.first_by("key", "doc_id")).select("doc_id")


@CATALOG.query("SELECT event_id, k FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END AS k, row_number() OVER (PARTITION BY CASE WHEN event_type = 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END ORDER BY event_id) AS n FROM events) WHERE n = 1 OR k = ''")
def doi_style_dedup(spark, sf_dir):
    """Blank keys are never merged."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("user_id").cast("string")).alias("k"))
    return rows.transform(D.first_or_blank("k", "event_id"))


@CATALOG.query("SELECT key, doc_id, part FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY part, doc_id) AS n FROM (SELECT doc_id, 1 AS part, lang || '-' || (doc_id % 700) AS key FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 0, lang || '-' || (doc_id % 700) FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT doc_id, 2, '' FROM documents)) WHERE n = 1 AND key <> ''")
def union_first_wins(spark, sf_dir):
    """Tables in file order as one; blank keys go."""
    docs = table(spark, sf_dir, "documents")
    key = F.concat("lang", F.lit("-"), (F.col("doc_id") % 700).cast("string")).alias("key")
    parts = [docs.where("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("part"), key), docs.where("doc_id % 2 = 1").select("doc_id", F.lit(0).alias("part"), key), docs.select("doc_id", F.lit(2).alias("part"), F.lit("").alias("key"))]
    return D.merge_tables(parts[0].unionByName(parts[1]).unionByName(parts[2]), "key", ("part", "doc_id")).select("key", "doc_id", "part")


@CATALOG.query("SELECT user_id, arg_max(event_id, row(ts, event_id)) AS event_id, arg_max(event_type, row(ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_per_key(spark, sf_dir):
    return table(spark, sf_dir, "events").transform(D.last_by("user_id", "ts", "event_id")).select("user_id", "event_id", "event_type")


@CATALOG.query("""
WITH m AS (SELECT user_id % 1000 AS k, event_id, CASE event_type WHEN 'purchase' THEN 'keep' WHEN 'click' THEN 'core' ELSE '' END AS keep, event_type AS notes FROM events),
f AS (SELECT k, arg_max(keep, event_id) FILTER (keep <> '') AS keep, arg_max(notes, event_id) AS notes FROM m GROUP BY k),
d AS (SELECT doc_id, doc_id // 3 AS k, row_number() OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) AS n FROM documents)
SELECT d.doc_id, coalesce(f.keep, '') AS keep, coalesce(f.notes, '') AS notes FROM d LEFT JOIN f ON d.k = f.k AND d.n = 1""")
def marks_upsert(spark, sf_dir):
    """Fold mark events into records: a blank keep changes nothing, notes always count, and only the first record of a key is marked."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 3).alias("k"), F.lit("").alias("keep"), F.lit("").alias("notes"))
    keep = F.when(F.col("event_type") == "purchase", "keep").when(F.col("event_type") == "click", "core").otherwise("")
    marks = table(spark, sf_dir, "events").select((F.col("user_id") % 1000).alias("k"), keep.alias("keep"), F.col("event_type").alias("notes"), "event_id")
    return D.upsert_marks(rows, marks, ["event_id"], "k", ["doc_id"]).select("doc_id", "keep", "notes")


@CATALOG.query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join(spark, sf_dir):
    return D.members(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@CATALOG.query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_existing(spark, sf_dir):
    """What is still to do: a left anti join to the manifest."""
    return D.without(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")

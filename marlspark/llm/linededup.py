"""Line dedup by a log-template tree; DataFrame functions only.

A line's tokens are its words between white space, with every token that holds a
digit generalised to ``<*>``. The tree has fixed depth: number of tokens, the
leading tokens, then the template. A line stands under its full template and, if
it is long enough, under three more, each with one third of the line generalised
to a variable field. A template that occurs in two documents or more recurs: its
lines are dropped everywhere but in the first of these documents (least doc_id).

Cases: null texts have no line and stay null; empty lines and lines under
``least`` tokens are kept; lines repeated within one document alone are kept;
rows with equal doc_id are one document, those without an id are told by their
text; a document that loses all its lines keeps an empty text; an empty table
gives an empty result. The order of rows does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Store, doc_key, packed, row_key, table

#: Leading tokens that are levels of the tree; fewest tokens of a line; fewest for a generalised third.
DEPTH, LEAST, LONG = 3, 3, 12
VARIABLE = "<*>"


def tokens(line: Column) -> Column:
    bare = F.regexp_replace(line, r"[\x09-\x0D]+", " ")
    masked = F.when(bare.rlike("[0-9]"), F.regexp_replace(bare, r"[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(bare)
    return F.array_remove(F.split(masked, " "), "")


def template_keys(t: Column, depth: int, least: int, long: int) -> Column:
    """Hashes of a line's templates: the full one, then those with a third generalised. Null where the line is too short."""
    n = F.size(t)
    third = F.ceil(n / 3).cast("int")
    leaf = F.xxhash64(n, F.slice(t, 1, depth))
    part = [F.slice(t, 1, third), F.slice(t, third + 1, third), F.slice(t, 2 * third + 1, third)]
    full = F.xxhash64(F.lit(0), leaf, *part)
    open_ = [F.xxhash64(F.lit(k + 1), leaf, *(part[:k] + part[k + 1 :])) for k in range(3)]
    return F.when(n >= long, F.array(full, *open_)).when(n >= least, F.array(full))


def keyed_lines(docs: DataFrame, text: str, doc_id: str, depth: int, least: int, long: int) -> DataFrame:
    """rk, dk, pos and key: one row for each template of each line."""
    lines = docs.select(row_key(text, doc_id).alias("rk"), doc_key(text, doc_id).alias("dk"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    t = lines.select("rk", "dk", "pos", tokens(F.col("line")).alias("t")).where(F.size("t") >= least)
    return t.select("rk", "dk", "pos", F.explode(template_keys(F.col("t"), depth, least, long)).alias("key"))


def drop_recurring_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", depth: int = DEPTH, least: int = LEAST, long: int = LONG) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``; n_lines and n_dropped are added, over columns of these names."""
    store = Store(docs.sparkSession, "lines")
    # Keys cost most, so they are made once; numbers alone, they are written small.
    keyed = store.keep(keyed_lines(docs, text, doc_id, depth, least, long))
    # Least and greatest document combine before the shuffle, so a line of a third of all documents is as cheap as any.
    recurring = store.keep(keyed.groupBy("key").agg(F.min("dk").alias("first"), F.max("dk").alias("last")).where("first < last").select("key", "first"))
    drops = keyed.join(recurring, "key").where("dk > first").groupBy(F.col("rk").alias("__drop_rk")).agg(F.collect_set("pos").alias("__drop"))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    body = docs.select(*columns, row_key(text, doc_id).alias("__drop_key")).join(drops, F.col("__drop_key") == F.col("__drop_rk"), "left")
    lines = F.split(F.col(text), "\n")
    # The places left are a difference of sets, so a text's work grows with its lines and not with lines times drops.
    left = lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__drop")), lambda i: F.get(x, i))
    kept = F.array_join(F.element_at(F.transform(F.array(lines), left), 1), "\n")
    changed = body.withColumns({
        "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
        text: F.when(F.col("__drop").isNull(), F.col(text)).otherwise(kept),
    })
    return changed.select(*columns, "n_lines", "n_dropped")


def op3_drop_recurring_lines(spark, sf_dir: str) -> DataFrame:
    kept = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


#: The same over strings in place of hashes.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents
), t AS (
  SELECT doc_id, pos, list_filter(string_split(regexp_replace(regexp_replace(line, '[\x09-\x0D]+', ' ', 'g'), '[^ ]*[0-9][^ ]*', '<*>', 'g'), ' '), lambda x: x <> '') AS t FROM l
), p AS (
  SELECT doc_id, pos, len(t) AS n, CAST(ceil(len(t) / 3.0) AS BIGINT) AS d, t FROM t WHERE len(t) >= 3
), s AS (
  SELECT doc_id, pos, n, array_to_string(t[1:3], ' ') AS lead, array_to_string(t[1:d], ' ') AS a, array_to_string(t[d+1:2*d], ' ') AS b, array_to_string(t[2*d+1:n], ' ') AS c FROM p
), k AS (
  SELECT doc_id, pos, concat_ws(chr(1), '0', n, a, b, c) AS key FROM s
  UNION ALL SELECT doc_id, pos, concat_ws(chr(1), '1', n, lead, b, c) FROM s WHERE n >= 12
  UNION ALL SELECT doc_id, pos, concat_ws(chr(1), '2', n, lead, a, c) FROM s WHERE n >= 12
  UNION ALL SELECT doc_id, pos, concat_ws(chr(1), '3', n, lead, a, b) FROM s WHERE n >= 12
), r AS (
  SELECT key, min(doc_id) AS first FROM k GROUP BY key HAVING min(doc_id) < max(doc_id)
), d AS (
  SELECT DISTINCT k.doc_id, k.pos FROM k JOIN r USING (key) WHERE k.doc_id > r.first
)
SELECT l.doc_id, count(*) AS n_lines, count(d.pos) AS n_dropped,
  md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (d.pos IS NULL), '')) AS kept_md5
FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.pos = d.pos GROUP BY l.doc_id
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without recurring lines; n_chars is that of the text left."""
    kept = drop_recurring_lines(packed(docs, "doc_id", "text"))
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    return kept.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])

"""Matching of documents, records and dossiers; catalogues; review state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import blank
from .containment import contained_first, containing
from .dedup import first_by
from .sequences import numbered


def catalog(**parts: DataFrame) -> DataFrame:
    """Full outer join of parts by basename: whether and with what each part has it.

    Each part has basename and value; a union and one aggregation in place of a join for each.
    """
    union = None
    for name, df in parts.items():
        rows = df.select("basename", F.lit(name).alias("part"), F.col("value").cast("string").alias("value"))
        union = rows if union is None else union.unionByName(rows)
    return union.groupBy("basename").agg(*[F.min(F.when(F.col("part") == n, F.col("value"))).alias(n) for n in parts])


def listed(parts: DataFrame, *models: str) -> DataFrame:
    """A catalogue's rows that have any model, in order of basename."""
    return parts.where(F.coalesce(*[F.col(m) for m in models]).isNotNull()).orderBy("basename")


def neighbours(df: DataFrame, group: Sequence[str], key: str, *order: str, page: int = 4) -> DataFrame:
    """place (from 1), page (from 0), previous and next of every record in review order, of a group or of all; the ends have none."""
    return numbered(df, order, group, key).withColumn("page", F.floor((F.col("place") - 1) / page).cast("long"))


def prioritized(items: DataFrame, wanted: DataFrame, key: str, rules: Sequence[Column], order: str, take: Sequence[str]) -> DataFrame:
    """For each wanted row the item that fits the first of ``rules`` that any fits; ties by ``order``."""
    # A join for each rule, so that each rule's equalities are its join keys; a pair counts by the first that it fits.
    pairs = None
    for i, r in enumerate(rules, 1):
        hit = wanted.join(items, r).withColumn("rule", F.lit(i))
        pairs = hit if pairs is None else pairs.unionByName(hit)
    return pairs.groupBy(key).agg(F.min_by(F.struct("rule", *take), F.struct("rule", order)).alias("__v")).select(key, "__v.*")


def stem(file: Column) -> Column:
    """A file's name without its last suffix."""
    return F.regexp_replace(F.regexp_extract(file, "[^/]*$", 0), r"(?<=.)\.[^.]*$", "")


#: Candidates that an ambiguous resolution lists.
OPTIONS = 5


def resolve(dossiers: DataFrame, papers: DataFrame, key: str, explicit: str | None = None) -> DataFrame:
    """The paper of each dossier: the path that ``explicit`` names, else by DOI, by squeezed title, by squeezed file stem.

    Both have doi, title and file; the papers path. Status is resolved, not_found or ambiguous, which has its first ``OPTIONS``
    candidates by path. A candidate counts by the first rule that it fits. Of papers that share a value as many are looked at as
    decide, so a value of very many makes no pairs.
    """
    doi = lambda d: X.normalized_text(F.trim(F.coalesce(d, F.lit(""))))
    squeezed = lambda c: X.squeezed(F.coalesce(c, F.lit("")))
    reasons = (("doi", doi, "doi"), ("title_exact", squeezed, "title"), ("filename_exact", lambda f: squeezed(stem(F.coalesce(f, F.lit("")))), "file"))
    values = lambda df, *more: df.select(*more, F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), of(F.col(c)).alias("v")) for i, (_, of, c) in enumerate(reasons)])).alias("x")).select(*more, "x.*").where("v != ''")
    first = F.row_number().over(Window.partitionBy("rule", "v").orderBy("path"))
    by_value = values(papers, "path").distinct().withColumn("n", first).where(F.col("n") <= OPTIONS + 1).groupBy("rule", "v").agg(F.collect_list(F.struct("path", "rule")).alias("hits"))
    met = values(dossiers, key).join(by_value, ["rule", "v"]).groupBy(key).agg(F.flatten(F.collect_list("hits")).alias("hits"))
    # At most three rules' firsts of each dossier; the least rule of a path is its reason.
    best = met.select(key, F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["path"]))).alias("paths"), F.array_min(F.transform("hits", lambda h: h["rule"])).alias("rule"))
    named = F.col(explicit) if explicit else F.lit(None).cast("string")
    joined = dossiers.select(key, named.alias("__explicit")).join(best, key, "left")
    told, n = F.col("__explicit").isNotNull(), F.coalesce(F.size("paths"), F.lit(0))
    status = F.when(told | (n == 1), "resolved").when(n > 1, "ambiguous").otherwise("not_found")
    why = F.when(told, "explicit_path").when(n == 1, F.element_at(F.array(*[F.lit(name) for name, *_ in reasons]), F.col("rule") + 1))
    return joined.select(key, status.alias("status"), F.coalesce("__explicit", F.when(n == 1, F.col("paths")[0])).alias("path"), why.alias("resolved_by"), F.when(~told & (n > 1), F.slice("paths", 1, OPTIONS)).alias("options"))


def first_titled(*models: Column) -> Column:
    """The first struct whose title is not blank, else the last there is."""
    return F.coalesce(*[F.when(~blank(m["title"]), m) for m in models], *reversed(models))


def model_record(there: Column, raw: Column, revised: Column) -> Column:
    """A model's own file where there is one, whatever it holds, else its revised one."""
    return F.when(there, raw).otherwise(revised)


def overlay(human: Column, revised: Column) -> Column:
    """The human's whole document where there is one, if there is a revised one at all."""
    return F.when(revised.isNotNull(), F.coalesce(human, revised))


def drafts(docs: DataFrame, index: DataFrame, key: str, take: Sequence[str], least: int = 200) -> DataFrame:
    """Records of an extraction: matched fields or blanks (year a number, 0 where there is none), the text, its length, and success from ``least`` characters on."""
    joined = docs.join(index.withColumn("__hit", F.lit(True)), key, "left")
    body = F.coalesce("body_text", F.lit(""))
    field = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) if c == "year" else F.coalesce(F.col(c).cast("string"), F.lit(""))
    return joined.select(key, *[field(c).alias(c) for c in take], body.alias("body_text"), F.length(body).cast("long").alias("text_length"), F.coalesce("__hit", F.lit(False)).alias("csv_matched"), F.when(F.length(body) >= least, "success").otherwise("failed").alias("extraction_status"))


def extraction_summary(d: DataFrame) -> DataFrame:
    """total, success, failed, no_csv_match: a draft without a record counts as that before all else."""
    return d.agg(F.count("*").alias("total"), F.count_if(F.col("csv_matched") & (F.col("extraction_status") == "success")).alias("success"), F.count_if(F.col("csv_matched") & (F.col("extraction_status") != "success")).alias("failed"), F.count_if(~F.col("csv_matched")).alias("no_csv_match"))


def search(df: DataFrame, query: str, *columns: str) -> DataFrame:
    return df.where(F.lower(F.concat_ws(" ", *columns)).contains(query.lower()))


def tagged(df: DataFrame, *tags: str, column: str = "keep") -> DataFrame:
    return df.where(F.lower(F.trim(column)).isin([t.lower() for t in tags]))


def progress(df: DataFrame, page: int = 4, column: str = "keep") -> DataFrame:
    return df.agg(F.count_if(F.trim(F.coalesce(column, F.lit(""))) != "").alias("reviewed"), F.count("*").alias("total"), F.ceil(F.count("*") / page).cast("long").alias("pages"))


def doi_lines(df: DataFrame, doi: str = "doi") -> DataFrame:
    return df.where(~blank(F.col(doi))).select(F.concat(F.lit("https://doi.org/"), F.col(doi)).alias("value"))


#: How grave a difference of a field is.
SEVERITY = {"title": "critical", "authors": "major", "year": "critical", "venue": "major", "doi": "major"}


def compare_metadata(pairs: DataFrame, key: str, fields: Sequence[str] = tuple(SEVERITY)) -> DataFrame:
    """One row for each field of a pair (a_<field>, p_<field>): field, both values, status and, of failures, severity.

    Texts pass if they are equal once normalised (case and punctuation count), authors partly if one holds the other.
    Years are compared as what they are: a number and a text are never alike.
    """
    kind = dict(pairs.dtypes)
    texts = {"string", "varchar", "char"}

    def alike(f: str) -> Column:
        a, p = F.col(f"a_{f}"), F.col(f"p_{f}")
        if f != "year":
            return X.normalized_text(F.coalesce(a.cast("string"), F.lit(""))) == X.normalized_text(F.coalesce(p.cast("string"), F.lit("")))
        return a.eqNullSafe(p) if (kind[f"a_{f}"] in texts) == (kind[f"p_{f}"] in texts) else a.isNull() & p.isNull()

    parts = [F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").cast("string").alias("analysis_value"), F.col(f"p_{f}").cast("string").alias("paper_value"), alike(f).alias("same")) for f in fields]
    rows = pairs.select(key, F.explode(F.array(*parts)).alias("x")).select(key, "x.*")
    a, p = X.normalized_text(F.coalesce("analysis_value", F.lit(""))), X.normalized_text(F.coalesce("paper_value", F.lit("")))
    partial = (F.col("field") == "authors") & (a != "") & (p != "") & (F.contains(a, p) | F.contains(p, a))
    status = F.when(F.col("same"), "pass").when(partial, "partial").otherwise("fail")
    grave = F.element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), F.col("field"))
    return rows.withColumn("status", status).withColumn("severity", F.when(F.col("status") == "fail", F.coalesce(grave, F.lit("major")))).drop("same")


def metadata_issues(checks: DataFrame, key: str) -> DataFrame:
    """Of compared metadata, the issues: key, severity, field, category and message."""
    return checks.where("status = 'fail'").select(key, "severity", "field", F.lit("metadata").alias("category"), F.lit("metadata differs from the paper's").alias("message"))


def candidates_first_title(df: DataFrame, order: str, title: str = "title") -> DataFrame:
    return df.withColumn("__t", X.normalized_title(F.col(title))).transform(first_by("__t", order)).drop("__t")

"""Field merge policies, and the whole enrichment of a table by them.

A policy says when a field of an answer may be written over a record's own. The rules of
a source are a table, applied in one projection; ``origin`` holds the name of the source
that wrote each field last, or null where the value is the record's own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import ENRICHED, UNAVAILABLE, blank, missing_abstract
from . import enrich as E

POLICIES = ("overwrite", "if_present", "fill")


@dataclass(frozen=True)
class Rule:
    """How ``field`` takes the ``value`` of an answer.

    overwrite: always, ``default`` where the answer has none. if_present: where the answer
    has one. fill: where the answer has one and the record's own is ``missing``.
    """

    field: str
    value: Callable[[Column], Column]
    policy: str
    default: str = ""
    missing: Callable[[Column], Column] = blank

    def __post_init__(self):
        if self.policy not in POLICIES:
            raise ValueError(f"{self.policy!r} is none of {', '.join(POLICIES)}")


def no_origin(fields: Sequence[str]) -> Column:
    return F.struct(*[F.lit(None).cast("string").alias(f) for f in fields])


def write(df: DataFrame, values: dict[str, tuple[Column, Column]], source: str) -> DataFrame:
    """Write to each field its value where its condition holds, and ``source`` to its origin; all see the state before."""
    wrote = {f: F.coalesce(when, F.lit(False)) for f, (when, _) in values.items()}
    fields = {f: F.when(wrote[f], v).otherwise(F.col(f)) for f, (_, v) in values.items()}
    names = df.schema["origin"].dataType.fieldNames()
    origin = F.struct(*[(F.when(wrote[f], source).otherwise(F.col(f"origin.{f}")) if f in wrote else F.col(f"origin.{f}")).alias(f) for f in names])
    return df.withColumns({**fields, "origin": origin})


def apply_rules(df: DataFrame, answer: str, source: str, rules: Sequence[Rule]) -> DataFrame:
    """Apply a source's rules where the struct ``answer`` is not null.

    ``df`` has ``origin`` (see ``no_origin``) with each of the rules' fields. A null value of an answer counts as blank.
    """
    values = {}
    for r in rules:
        new = r.value(F.col(answer)).cast("string")
        when = F.col(answer).isNotNull()
        if r.policy != "overwrite":
            when = when & ~blank(new)
        if r.policy == "fill":
            when = when & r.missing(F.col(r.field))
        values[r.field] = (when, F.when(blank(new), r.default).otherwise(new))
    return write(df, values, source)


#: What an answer about a record may hold, and the rules by which a record takes it.
ANSWER = ("s2_paper_id", "citation_count", "abstract", "arxiv_id", "published_date", "fields_of_study")
RECORD = (
    Rule("citation_count", lambda a: a["citation_count"], "overwrite", "0"),
    Rule("s2_paper_id", lambda a: a["s2_paper_id"], "overwrite"),
    Rule("abstract", lambda a: a["abstract"], "fill", missing=missing_abstract),
    Rule("arxiv_id", lambda a: a["arxiv_id"], "if_present"),
    Rule("published_date", lambda a: F.substring(a["published_date"], 1, 10), "if_present"),
    Rule("categories", lambda a: F.array_join(a["fields_of_study"], "; "), "fill"),
)
RULED = tuple(r.field for r in RECORD)


def _answer(*columns: str) -> Column:
    return F.struct(*columns).alias("__a")


def _batch(rows: DataFrame, found: DataFrame) -> DataFrame:
    asked = rows.withColumn("__ask", F.when(F.col("__on"), F.col("doi")))
    return E.by_doi(asked, found.select("id", _answer(*ANSWER)), "__ask").transform(lambda d: apply_rules(d, "__a", "batch", RECORD)).drop("__ask", "__a")


def _open(rows: DataFrame) -> Column:
    return F.col("__on") & blank(F.col("doi")) & missing_abstract(F.col("abstract"))


def _bulk(rows: DataFrame, found: DataFrame) -> DataFrame:
    group = {"__venue": F.trim("venue"), "__year": F.trim("year")}
    asked = rows.withColumns({"__ask": F.when(_open(rows), F.col("title")), **group})
    own = F.trim(F.coalesce(F.col("candidate_year").cast("string"), F.lit("")))
    pool = found.withColumns(group).where((own == "") | (own == F.col("__year"))).select("__venue", "__year", F.col("title").alias("__ask"), "rank", _answer(*ANSWER))
    joined = E.by_title_in_group(asked, pool, "rank", ["__a"], ("__venue", "__year"), "__ask")
    return apply_rules(joined, "__a", "bulk", RECORD).drop("__ask", "__venue", "__year", "__a")


def _search(rows: DataFrame, found: DataFrame) -> DataFrame:
    asked = rows.withColumns({"__ask": F.when(_open(rows) & (F.trim("title") != ""), F.trim("title")), "__year": F.trim("year")})
    pool = found.select(F.col("title").alias("__ask"), F.trim(F.col("year").cast("string")).alias("__year"), "rank", _answer(*ANSWER))
    joined = apply_rules(E.by_title(asked, pool, "__at", "rank", ["__a"], "__ask", "__year"), "__a", "search", RECORD)
    unanswered = F.col("__ask").isNotNull() & F.col("__a").isNull()
    return write(joined, {"abstract": (unanswered, F.lit(UNAVAILABLE))}, "none").drop("__ask", "__year", "__a")


def _fallback(rows: DataFrame, found: DataFrame, name: str, key: str, text: Callable[[Column], Column], strict: bool) -> DataFrame:
    """One source of the fallback chain: its text, or else its error, is written where the abstract is missing still."""
    asked = rows.withColumn("__ask", F.when(F.col("__on") & ~F.col("__stop") & missing_abstract(F.col("abstract")), F.col(key)))
    joined = E.by_doi(asked, found.select(F.col(key).alias("id"), _answer("abstract", "error")), "__ask", prefix="")
    error, raw = F.col("__a.error"), F.col("__a.abstract")
    failed, answered = ~blank(error), blank(error) & ~blank(raw)
    ended = F.col("__a").isNotNull() & (answered | (failed & F.lit(strict)))
    joined = joined.withColumn("__stop", F.col("__stop") | F.coalesce(ended, F.lit(False)))
    return write(joined, {"abstract": (F.col("__a").isNotNull() & (failed | answered), F.when(failed, error).otherwise(text(raw)))}, name).drop("__ask", "__a")


def _enriched(rows: DataFrame, batch, bulk, search, registry, preprints, strict: bool) -> DataFrame:
    for found, step in ((batch, _batch), (bulk, _bulk), (search, _search)):
        if found is not None:
            rows = step(rows, found)
    rows = rows.withColumn("__stop", F.lit(False))
    if registry is not None:
        rows = _fallback(rows, registry, "registry", "doi", lambda t: F.trim(X.strip_jats(t)), strict)
    if preprints is not None:
        rows = _fallback(rows, preprints, "preprints", "arxiv_id", lambda t: t, strict)
    if registry is None and preprints is None:
        return rows.drop("__stop")
    return write(rows, {"abstract": (F.col("__on") & ~F.col("__stop") & blank(F.col("abstract")), F.lit(UNAVAILABLE))}, "none").drop("__stop")


def enrich_table(
    papers: DataFrame,
    crawled_date: str,
    order: Sequence[str],
    batch: DataFrame | None = None,
    bulk: DataFrame | None = None,
    search: DataFrame | None = None,
    registry: DataFrame | None = None,
    preprints: DataFrame | None = None,
    key: str = "paper_id",
    force: bool = False,
    limit: int | None = None,
    strict: bool = False,
    human: Sequence[str] = ("keep", "notes"),
) -> DataFrame:
    """All rows of ``papers`` with the columns of an enriched table, and ``origin``.

    Rows that need it (all, by ``force``; the first ``limit`` of them in ``order``, whose columns tell rows apart) are enriched:
    by id (``batch``: id, ANSWER), without a DOI by title within venue and year (``bulk``: venue, year, title, candidate_year,
    rank, ANSWER), then by title (``search``: title, year, rank, ANSWER), and where the abstract is missing still from ``registry``
    (doi, abstract, error) and ``preprints`` (arxiv_id, abstract, error). A source left out is not asked.

    An error becomes the abstract; by ``strict`` it also ends the chain for its record, else the next source may still fill it.
    An abstract that is blank once its markup is gone ends the chain too. Of rows that share a key the last one's values that are
    not blank count for all, human columns apart, and so does its origin.
    """
    columns = ENRICHED.fieldNames()
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("__at")
    rows = papers.select(place, *E.default_columns(papers, crawled_date, columns)).withColumn("origin", no_origin(RULED))
    due = F.lit(True) if force else E.needs_enrichment(F.col("abstract"), F.col("citation_count"))
    if limit:
        first = rows.where(due).orderBy("__at").limit(limit).select("__at", F.lit(True).alias("__on"))
        rows = rows.join(first, "__at", "left").withColumn("__on", F.coalesce("__on", F.lit(False)))
    else:
        rows = rows.withColumn("__on", due)
    sources = (batch, bulk, search, registry, preprints, strict)
    # Only rows that share a key with others take from the last of them, so only these are enriched twice.
    shared = rows.groupBy(key).agg(F.count("*").alias("n"), F.count_if("__on").alias("due")).where("n > 1 AND due > 0").select(key)
    last = _enriched(rows.where("__on").join(shared, key, "left_semi"), *sources)
    merged = [c for c in (*columns, "origin") if c != key]
    return E.merge_back(_enriched(rows, *sources), last, merged, key, "__at", human).select(*columns, "origin")


def origin_counts(enriched: DataFrame) -> DataFrame:
    """field, source and n: how many values each source wrote last; ``original`` are the records' own."""
    fields = enriched.schema["origin"].dataType.fieldNames()
    counts = enriched.groupBy("origin").agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f"origin.{f}"), F.lit("original")).alias("source")) for f in fields]))
    return counts.select(each.alias("x"), "n").groupBy("x.field", "x.source").agg(F.sum("n").alias("n"))

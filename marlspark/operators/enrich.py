"""Enrichment of records from lookup tables, in order of priority.

Lookups are DataFrames, so a cascade is left joins and one projection. Join sides
are not hinted: Spark broadcasts what it knows to be small and AQE the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import ENRICHED, UNAVAILABLE, blank, missing_abstract
from .dedup import file_order, first_by, last_by


def default_columns(df: DataFrame, crawled_date: str, columns: Sequence[str]) -> list[Column]:
    default = {"abstract": "", "citation_count": "0", "source": "dblp", "crawled_date": crawled_date}
    return [F.coalesce(F.col(c).cast("string"), F.lit(default.get(c, ""))).alias(c) if c in df.columns else F.lit(default.get(c, "")).alias(c) for c in columns]


def with_defaults(df: DataFrame, crawled_date: str, columns: Sequence[str] = tuple(ENRICHED.fieldNames())) -> DataFrame:
    """All columns of an enriched table as strings; what is absent gets its default."""
    return df.select(*default_columns(df, crawled_date, columns))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns as strings, blank where absent or null."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def needs_enrichment(abstract: Column, citations: Column) -> Column:
    return missing_abstract(abstract) | F.coalesce(citations.cast("string"), F.lit("")).isin("", "0")


def by_doi(papers: DataFrame, found: DataFrame, doi: str = "doi", lookup_id: str = "id", prefix: str = "DOI:") -> DataFrame:
    """Left join on ``DOI:{doi}``; blank DOIs match nothing. Of several answers for an id the least counts."""
    key = F.when(~blank(F.col(doi)), F.concat(F.lit(prefix), F.col(doi)))
    found = found.transform(first_by(lookup_id, *[c for c in found.columns if c != lookup_id]))
    return papers.join(found.withColumnRenamed(lookup_id, "__id"), key == F.col("__id"), "left").drop("__id")


def by_title_in_group(papers: DataFrame, candidates: DataFrame, order: str, take: Sequence[str], group: Sequence[str] = ("venue", "year"), title: str = "title") -> DataFrame:
    """Left join on venue, year and normalised title. The first candidate of a title counts; papers with a blank group are skipped."""
    pool = candidates.withColumn("__t", X.normalized_title(F.col(title))).where("__t != ''").transform(first_by([*group, "__t"], order))
    pool = pool.select(*[F.col(g).alias(f"__{g}") for g in group], "__t", *take)
    on = [F.col(g) == F.col(f"__{g}") for g in group] + [X.normalized_title(papers[title]) == F.col("__t")] + [~blank(papers[g].cast("string")) for g in group]
    return papers.join(pool, on, "left").drop("__t", *[f"__{g}" for g in group])


def by_title(papers: DataFrame, candidates: DataFrame, key: str, order: str, take: Sequence[str], title: str = "title", year: str = "year") -> DataFrame:
    """Left join on normalised title where either year is blank or both agree; the first such candidate counts."""
    pool = candidates.select(X.normalized_title(F.col(title)).alias("__t"), F.col(year).cast("string").alias("__y"), F.col(order).alias("__o"), F.struct(*take).alias("__v")).where("__t != ''")
    # One candidate for each title and year is enough, so a title that all share gives few pairs.
    pool = pool.withColumn("__y", F.coalesce("__y", F.lit(""))).transform(first_by(["__t", "__y"], "__o"))
    own = papers.select(key, X.normalized_title(F.col(title)).alias("__t"), F.col(year).cast("string").alias("__p"))
    fits = own.join(pool, "__t").where(blank(F.col("__p")) | blank(F.col("__y")) | (F.col("__p") == F.col("__y")))
    first = fits.groupBy(key).agg(F.min_by("__v", "__o").alias("__v"))
    return papers.join(first, key, "left").select("*", *[F.col(f"__v.{c}").alias(c) for c in take]).drop("__v")


def cascade(papers: DataFrame, steps: Sequence[tuple[str, DataFrame]], key: str = "paper_id", value: str = "abstract", last: str = UNAVAILABLE) -> DataFrame:
    """Fill a missing value from the first step that has one; ``filled_from`` names the step, "original" or "none".

    Each step is a DataFrame of key and value, one row for each key.
    """
    joined = papers.withColumn("__0", F.when(~missing_abstract(F.col(value)), F.col(value)))
    names = ["original"]
    for i, (name, found) in enumerate(steps, 1):
        joined = joined.join(found.select(key, F.when(~missing_abstract(F.col(value)), F.col(value)).alias(f"__{i}")), key, "left")
        names.append(name)
    slots = [f"__{i}" for i in range(len(names))]
    source = F.lit("none")
    for n, s in reversed(list(zip(names, slots, strict=True))):
        source = F.when(F.col(s).isNotNull(), n).otherwise(source)
    return joined.withColumns({"filled_from": source, value: F.coalesce(*slots, F.lit(last))}).drop(*slots)


def merge_back(rows: DataFrame, updates: DataFrame, columns: Sequence[str], key: str = "paper_id", order: str | None = None, human: Sequence[str] = ("keep", "notes")) -> DataFrame:
    """Overwrite by new values that are not blank; human columns never. The last update of a key counts."""
    new = updates.groupBy(key).agg(*[(F.max_by(c, order) if order else F.max(c)).alias(f"__{c}") for c in columns if c not in human])
    joined = rows.join(new, key, "left")
    return joined.withColumns({c: F.when(~blank(F.col(f"__{c}").cast("string")), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns if c not in human}).drop(*[f"__{c}" for c in columns])


def fill_counts(cascaded: DataFrame) -> DataFrame:
    """What a cascade did: rows by the step that filled them, "original" and "none" included."""
    return cascaded.groupBy("filled_from").agg(F.count("*").alias("n"))


def lookup_counts(asked: DataFrame, value: str = "abstract", hit: str = "found") -> DataFrame:
    """asked, enriched (ids that were found) and abstracts (found with a value that is no placeholder)."""
    good = F.col(hit) & ~blank(F.col(value)) & ~F.startswith(F.col(value), F.lit("["))
    return asked.agg(F.count("*").alias("asked"), F.count_if(F.col(hit)).alias("enriched"), F.count_if(good).alias("abstracts"))


def reattach(rows: DataFrame, human: DataFrame, key: str = "paper_id", columns: Sequence[str] = ("keep", "notes"), order: Sequence[str] = ()) -> DataFrame:
    """Human columns of an earlier output win over those of ``rows``; the last row of a key there, by ``order`` (file order), counts."""
    kept = human.where(~blank(F.col(key).cast("string"))).transform(last_by(key, *(order or file_order(human)))).select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = rows.join(kept, key, "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c if c in rows.columns else F.lit("")) for c in columns}).drop(*[f"__{c}" for c in columns])


def group_limits(papers: DataFrame, *group: str) -> DataFrame:
    """How many candidates to ask for: four for each paper of the group, 25 to 200."""
    return papers.groupBy(*group).agg(F.count("*").alias("n")).withColumn("candidates", F.least(F.greatest(F.col("n") * 4, F.lit(25)), F.lit(200)).cast("long"))

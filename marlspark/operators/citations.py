"""A citation graph inside one set of papers.

Papers are known by several ids. Those that share an id are one work, directly or over
others; references name their ends by any id, and only those with both ends in the set
become edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import blank
from ..sources.shared import delete, new_folder

# How ids are asked for, in the order in which they are tried.
PREFIXES = {"s2_paper_id": "S2:", "doi": "DOI:", "arxiv_id": "ARXIV:"}


def alias(column: str) -> Column:
    """An id as references name it, null where blank: DOIs in lower case, preprints without their version."""
    value = F.trim(column)
    if column == "doi":
        value = F.lower(value)
    elif column == "arxiv_id":
        value = F.regexp_replace(value, "v[0-9]+$", "")
    return F.when(~blank(value), F.concat(F.lit(PREFIXES[column]), value))


def lookup_id(*columns: str) -> Column:
    """The id by which a paper's references are asked for: the first that is not blank."""
    return F.coalesce(*[alias(c) for c in columns or PREFIXES])


def aliases(papers: DataFrame, key: str = "paper_id") -> DataFrame:
    """alias and ``key``, a row for each id of each paper; papers without a key have none."""
    ids = F.array_compact(F.array(*[alias(c) for c in PREFIXES]))
    return papers.where(F.col(key).isNotNull()).select(F.explode(ids).alias("alias"), key)


def components(links: DataFrame) -> DataFrame:
    """node and component for pairs (u, v): the smallest node that a path of pairs leads to.

    Pairs are turned to point from the larger to the smaller node. Each round hangs first every larger, then every
    smaller neighbour of a node from the smallest one, until nothing changes; rounds grow with the logarithm of the
    longest path. A node with very many neighbours is a group of a combining aggregate and the hot side of a join
    that adaptive execution splits. Nothing but a count and a checksum reaches the driver.
    """
    spark = links.sparkSession
    base = new_folder(spark, "components")
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def kept(df: DataFrame, number: int) -> tuple[DataFrame, tuple]:
        df.write.option("parquet.enable.dictionary", "false").parquet(f"{base}/{number}")
        read = spark.read.schema(df.schema).parquet(f"{base}/{number}")
        return read, tuple(read.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def hung(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("u").agg(F.min("v").alias("m"))
        return rows.join(least.withColumn("m", F.least("u", "m")), "u")

    edges, seen = kept(pairs, 0)
    number, before = 0, None
    while seen != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hung(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = hung(large).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        number, before = number + 1, seen
        edges, seen = kept(small.where("u <> v").distinct(), number)
        delete(spark, f"{base}/{number - 1}")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def works(papers: DataFrame, key: str = "paper_id") -> DataFrame:
    """``key`` and work for each paper with a key: the smallest key of all that share an id, its own where none does."""
    names = aliases(papers, key)
    first = names.groupBy("alias").agg(F.min(key).alias("__first"))
    links = names.join(first, "alias").select(F.col(key).alias("u"), F.col("__first").alias("v"))
    found = components(links).select(F.col("node").alias(key), "component")
    own = papers.where(F.col(key).isNotNull()).select(key).distinct()
    return own.join(found, key, "left").select(key, F.coalesce("component", key).alias("work"))


def edges_inside(references: DataFrame, papers: DataFrame, members: DataFrame, key: str = "paper_id") -> DataFrame:
    """citing, cited and n: edges between two works of the set, with the number of references behind each.

    ``references`` are pairs of aliases (citing, cited), ``members`` is the result of ``works``. Pairs are counted
    before they meet names, so that a reference that repeats very often is one row. A work doesn't cite itself.
    """
    names = aliases(papers, key).join(members, key).groupBy("alias").agg(F.min("work").alias("work"))
    rows = references.groupBy("citing", "cited").agg(F.count("*").alias("n"))
    for end in ("citing", "cited"):
        rows = rows.join(names.select(F.col("alias").alias(end), F.col("work").alias(f"__{end}")), end)
    return rows.where("__citing <> __cited").groupBy(F.col("__citing").alias("citing"), F.col("__cited").alias("cited")).agg(F.sum("n").alias("n"))


def degrees(edges: DataFrame, members: DataFrame) -> DataFrame:
    """work, cites and cited_by: how many works of the set each one cites, and is cited by; zeros included."""
    none = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    out = edges.select(F.col("citing").alias("work"), one.alias("cites"), none.alias("cited_by"))
    back = edges.select(F.col("cited").alias("work"), none.alias("cites"), one.alias("cited_by"))
    rows = out.unionByName(back).unionByName(members.select("work", none.alias("cites"), none.alias("cited_by")))
    return rows.groupBy("work").agg(F.sum("cites").alias("cites"), F.sum("cited_by").alias("cited_by"))


def summary(edges: DataFrame, counted: DataFrame) -> DataFrame:
    """One row: works, edges, isolated works, and the most that a work cites or is cited by (null without works)."""
    alone = F.count_if((F.col("cites") == 0) & (F.col("cited_by") == 0))
    nodes = counted.agg(F.count("*").alias("n_works"), alone.alias("n_isolated"), F.max("cites").alias("most_cites"), F.max("cited_by").alias("most_cited_by"))
    return nodes.crossJoin(edges.agg(F.count("*").alias("n_edges")))  # one row and one row


def most_cited(counted: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` works that are cited most, with their place; ties go to the smaller work."""
    best = counted.orderBy(F.desc("cited_by"), "work").limit(n)
    return best.select(F.row_number().over(Window.orderBy(F.desc("cited_by"), "work")).alias("place"), "work", "cites", "cited_by")


def dot_lines(edges: DataFrame, titles: DataFrame) -> DataFrame:
    """The graph's body in the DOT language, a line a row: nodes (work, title), then edges; ``write_lines`` writes it.

    The lines have no order, which the language doesn't ask for; ``digraph {`` and ``}`` stand around them.
    """
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    name = lambda c: quote(F.col(c).cast("string"))
    nodes = titles.select(F.concat(name("work"), F.lit(" [label="), quote(F.regexp_replace(F.coalesce("title", F.lit("")), r"\s+", " ")), F.lit("];")).alias("value"))
    return nodes.unionByName(edges.select(F.concat(name("citing"), F.lit(" -> "), name("cited"), F.lit(";")).alias("value")))

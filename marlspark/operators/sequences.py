"""Ordinals, neighbours and streaks of long sequences, without a task that holds a whole one.

Rows are dealt to partitions by ranges of group and order and sorted there, so a
sequence lies across as many partitions as it needs. What a partition has of a
sequence is a segment; segments are summed up in one row each, the rows of a
sequence's segments (one for each partition at most) are combined in order, and every
row adds what its segment begins with.

Cases: null groups are a group; order columns are compared as Spark sorts them (nulls first)
and should tell rows apart, else ties stand in any order; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut


def dealt(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` by ranges, with __part and __at: partition and place in it. Written, for ranges are drawn from a sample."""
    by = [F.col(c) for c in (*group, *order)]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # The id's low 33 bits count a partition's rows as they come.
    return cut(ranged.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at")))


def segments(rows: DataFrame, group: Sequence[str], *facts: Column) -> DataFrame:
    """One row for each segment: __part, group, __n, __start and ``facts``."""
    return rows.groupBy("__part", *group).agg(F.count("*").alias("__n"), F.min("__at").alias("__start"), *facts)


def with_segments(rows: DataFrame, own: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` beside their segment's row."""
    own = own.withColumnsRenamed({c: f"__s{i}" for i, c in enumerate(("__part", *group))})
    same = [F.col(c).eqNullSafe(F.col(f"__s{i}")) if i else F.col(c) == F.col(f"__s{i}") for i, c in enumerate(("__part", *group))]
    return rows.join(own, reduce(and_, same)).drop(*[f"__s{i}" for i in range(len(same))])


def numbered(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), key: str | None = None) -> DataFrame:
    """``df`` with ``place`` (from 1) in its group and, with ``key``, that of the rows before and after: previous and next."""
    rows = dealt(df, group, order)
    facts = [F.min_by(key, "__at").alias("__first"), F.max_by(key, "__at").alias("__last")] if key else []
    along = Window.partitionBy(*group).orderBy("__part") if group else Window.partitionBy(F.lit(0)).orderBy("__part")  # segments only
    sums = segments(rows, group, *facts)
    before = F.coalesce(F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before")
    edges = [F.lag("__last").over(along).alias("__earlier"), F.lead("__first").over(along).alias("__later")] if key else []
    own = with_segments(rows, sums.select("__part", *group, "__n", "__start", before, *edges), group)
    out = own.withColumn("place", F.col("__at") - F.col("__start") + F.col("__before") + 1)
    if key:
        here = Window.partitionBy("__part", *group).orderBy("__at")  # a segment, no larger than a partition
        begins, ends = F.col("__at") == F.col("__start"), F.col("__at") == F.col("__start") + F.col("__n") - 1
        out = out.withColumns({"previous": F.when(begins, F.col("__earlier")).otherwise(F.lag(key).over(here)), "next": F.when(ends, F.col("__later")).otherwise(F.lead(key).over(here))})
    return out.select(*df.columns, "place", *(["previous", "next"] if key else []))


def paged(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), size: int = 4) -> DataFrame:
    """``df`` with ``page`` (from 0): runs of ``size`` rows in order."""
    return numbered(df, order, group).withColumn("page", F.floor((F.col("place") - 1) / size).cast("long")).drop("place")


def streaks(events: DataFrame, order: Sequence[str], failed: str, group: Sequence[str] = ()) -> DataFrame:
    """``events`` with ``streak``: failures in a row so far, 0 after a success; a null ``failed`` is a success.

    A segment is summed up as (has a success, failures after its last one). Such summaries
    combine associatively: what a segment begins with is the sum of the trailing failures
    of those before it, back to the last that has a success.
    """
    rows = dealt(events.withColumn("__bad", F.coalesce(F.col(failed), F.lit(False))), group, order)
    good = F.when(~F.col("__bad"), F.col("__at"))
    sums = segments(rows, group, F.max(good).alias("__good"))
    trailing = F.col("__start") + F.col("__n") - 1 - F.coalesce("__good", F.col("__start") - 1)
    keys = list(group) or [F.lit(0)]
    along = Window.partitionBy(*keys).orderBy("__part")
    sums = sums.withColumns({"__tail": trailing, "__run": F.count("__good").over(along.rowsBetween(Window.unboundedPreceding, 0))})
    run = Window.partitionBy(*keys, "__run").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("__so_far", F.sum("__tail").over(run)).withColumn("__carry", F.coalesce(F.lag("__so_far").over(along), F.lit(0)))
    own = with_segments(rows, sums.select("__part", *group, "__start", "__carry"), group)
    last = F.max(good).over(Window.partitionBy("__part", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("__last", last)
    streak = F.when(F.col("__last").isNull(), F.col("__at") - F.col("__start") + 1 + F.col("__carry")).otherwise(F.col("__at") - F.col("__last"))
    return own.select(*events.columns, streak.alias("streak"))

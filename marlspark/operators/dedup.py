"""First or last row for each key, unions, and membership."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool) -> DataFrame:
    # min_by/max_by combine before the shuffle, so a key with very many rows sends one for each task.
    # Keys are not in the row a second time.
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest] or [F.lit(None).alias("none")])
    place = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    best = F.max_by(row, place) if last else F.min_by(row, place)
    return df.groupBy(*keys).agg(best.alias("__row")).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def file_order(df: DataFrame) -> list[str]:
    """The columns of file order that ``df`` has, or all its columns where it has none."""
    return [c for c in ("_file", "_row") if c in df.columns] or list(df.columns)


def first_by(keys: str | Sequence[str], *order: str | Column) -> Callable[[DataFrame], DataFrame]:
    """The first row of each key in ``order``, which must tell rows apart."""
    return lambda df: _pick(df, [keys] if isinstance(keys, str) else keys, order, False)


def last_by(keys: str | Sequence[str], *order: str | Column) -> Callable[[DataFrame], DataFrame]:
    return lambda df: _pick(df, [keys] if isinstance(keys, str) else keys, order, True)


def merge_tables(df: DataFrame, key: str = "paper_id", order: Sequence[str | Column] = ("_file", "_row")) -> DataFrame:
    """Rows of several tables read as one: blank keys go, the first row of a key stays."""
    return df.where(F.coalesce(key, F.lit("")) != "").transform(first_by(key, *order))


def first_or_blank(key: str, *order: str | Column) -> Callable[[DataFrame], DataFrame]:
    """The first row of each key that is not blank, and all rows whose key is."""

    def apply(df: DataFrame) -> DataFrame:
        blank = F.coalesce(key, F.lit("")) == ""
        return df.where(~blank).transform(first_by(key, *order)).unionByName(df.where(blank))

    return apply


def upsert_marks(rows: DataFrame, marks: DataFrame, order: Sequence[str], key: str = "paper_id", row_order: Sequence[str] = ()) -> DataFrame:
    """Fold mark events into ``rows``: the last keep that is not blank, and the last notes.

    Only the first row of a key, by ``row_order`` (file order), takes marks; events are key, keep, notes and ``order``.
    """
    place, row_order = F.struct(*order), row_order or file_order(rows)
    folded = marks.groupBy(key).agg(F.max_by("keep", F.when(F.coalesce("keep", F.lit("")) != "", place)).alias("__keep"), F.max_by("notes", place).alias("__notes"))
    first = rows.groupBy(key).agg(F.min(F.struct(*row_order)).alias("__first")).join(folded, key).withColumnRenamed(key, "__key")
    joined = rows.join(first, (rows[key] == F.col("__key")) & (F.struct(*row_order) == F.col("__first")), "left").drop("__key", "__first")
    return joined.withColumns({"keep": F.coalesce(F.nullif("__keep", F.lit("")), "keep"), "notes": F.coalesce("__notes", "notes")}).drop("__keep", "__notes")


def members(df: DataFrame, others: DataFrame, *keys: str) -> DataFrame:
    return df.join(others.select(*keys).distinct(), list(keys), "left_semi")


def without(df: DataFrame, others: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not in ``others``: what is still to do."""
    return df.join(others.select(*keys).distinct(), list(keys), "left_anti")

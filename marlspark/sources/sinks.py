"""Writers: CSV with all fields quoted, partitioned tables, lists, JSON, event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import extraction_summary
from ..operators.enrich import project, reattach
from ..operators.scoring import TOPS, top
from .tables import exists

CSV = {"header": "true", "quoteAll": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}


def write_csv(df: DataFrame, path: str, columns: list[str], files: int | None = None) -> None:
    """These columns, all quoted; the commit protocol publishes all files or none. Partitions are kept, unless ``files`` asks for fewer."""
    rows = project(df, columns)
    (rows.coalesce(files) if files else rows).write.mode("overwrite").options(**CSV).csv(path)


def write_partitioned(df: DataFrame, path: str, keys: tuple[str, ...] = ("venue", "year"), force: bool = False) -> None:
    """Parquet by key; partitions that are there stay unless ``force``, which overwrites those written anew."""
    spark = df.sparkSession
    if not force and exists(spark, path):
        done = spark.read.parquet(path).select(*keys).distinct()
        df = df.join(done, list(keys), "left_anti")
    elif force:
        df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        return
    df.repartition(*keys).write.mode("append").partitionBy(*keys).parquet(path)


def write_tops(scored: DataFrame, folder: str, columns: list[str], *order: str) -> list[int]:
    """The 10, 50 and 100 best, from one ranking; none is written once nothing scores."""
    best = top(scored, max(TOPS), *order).collect()
    done = []
    for n in TOPS:
        if best:
            write_csv(scored.sparkSession.createDataFrame(best[:n], scored.schema), f"{folder}/top{n}", columns, files=1)
            done.append(n)
    return done


def write_keeping_marks(df: DataFrame, earlier: DataFrame, path: str, columns: list[str]) -> None:
    """As write_csv, with keep and notes of the earlier output, which has its order (_file, _row)."""
    write_csv(reattach(df, earlier), path, columns)


def write_lines(df: DataFrame, path: str, column: str = "value", files: int | None = None) -> None:
    rows = df.select(F.col(column).cast("string").alias("value"))
    (rows.coalesce(files) if files else rows).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, folder: str) -> None:
    """JSON documents (many in a file), an index of them without their texts, and a summary of the extraction."""
    df.write.mode("overwrite").json(f"{folder}/documents")
    df.drop("body_text").write.mode("overwrite").json(f"{folder}/index")
    extraction_summary(df).write.mode("overwrite").json(f"{folder}/summary")


def write_status(runs: DataFrame, path: str, tail: int = 4000) -> None:
    """Status records with the last ``tail`` characters of their output and errors; records of earlier runs stay."""
    ends = {f"{c}_tail": F.right(F.coalesce(c, F.lit("")), F.lit(tail)) for c in ("stdout", "stderr")}
    runs.withColumns(ends).drop("stdout", "stderr").write.mode("append").json(path)


def append_events(events: DataFrame, path: str) -> None:
    """Marks, status records and whole-document edits are appended; readers fold them by key."""
    events.write.mode("append").parquet(path)


def write_run_summary(runs: DataFrame, folder: str) -> None:
    """All run records, and those with a failed stage."""
    runs.write.mode("overwrite").json(f"{folder}/summary")
    runs.where("analysis_status = 'failed' or review_status = 'failed'").write.mode("overwrite").json(f"{folder}/failed")

"""The folder that driver and executors share, and lineage cuts there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder only in local sessions without it (tests, one machine)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp("-marlspark")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: what was drawn or dealt stays as it is."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new shared folder and read from there, so that Spark knows its size.

    Without dictionaries, for Spark broadcasts by size of files: runs of numbers would take far less there than in memory.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("parquet.enable.dictionary", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of working tables that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

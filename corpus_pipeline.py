"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Language ID drops documents that it rejects; line dedup takes out lines of
recurring templates; near-dedup keeps one document of each class; decontamination
drops documents that hold a passage of the benchmark; mixing draws the rest to
target weights, as pieces of documents by shard and position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marlspark.llm import langid, leaks, linededup, mixing, neardup
from marlspark.llm.common import delete, scratch, shared_folder

STAGES = [
    ("language_id", langid.stage),
    ("line_dedup", linededup.stage),
    ("near_dedup", neardup.stage),
    ("decontamination", leaks.stage),
    ("mixing", mixing.stage),
]

#: SQL can't express the learned stages, signatures and draws; tests/llm compares classes, items, draws and centroids with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared checkpoint folder and read again.

    Once a stage is written, its working tables and the result before it are deleted, so at most two results are kept at a time.
    """
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        with scratch(spark, f"{base}/{k}-scratch"):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs

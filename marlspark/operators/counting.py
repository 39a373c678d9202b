"""Counts of a job's stages in passing: one action, no second scan.

Each stage's rows are observed as they go by. The counts are there once an action has run over
the whole of the last stage; stages that a limit cuts short are counted as far as they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """``at`` marks a stage of a DataFrame; after an action ``rows`` tells what each stage has seen, in order."""

    def __init__(self):
        self.stages: list[tuple[str, Observation]] = []

    def at(self, df: DataFrame, stage: str, **metrics: Column) -> DataFrame:
        """``df``, observed: its rows as ``n``, and further aggregates by name."""
        seen = Observation()
        self.stages.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"), *[m.alias(k) for k, m in metrics.items()])

    def run(self, df: DataFrame) -> list[dict]:
        """Run ``df`` for its counts alone and return them by stage."""
        df.write.format("noop").mode("overwrite").save()
        return self.rows()

    def rows(self) -> list[dict]:
        return [{"stage": stage, **seen.get} for stage, seen in self.stages]

    def table(self, spark: SparkSession) -> DataFrame:
        """stage and n, a row for each stage."""
        return spark.createDataFrame([(r["stage"], r["n"]) for r in self.rows()], "stage string, n long")

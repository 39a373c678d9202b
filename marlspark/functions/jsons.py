"""JSON found in other text, and bundles of documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DOSSIER, REVIEW


def first_object(df: DataFrame, text: str, to: str = "json") -> DataFrame:
    """Replace ``text`` by the first JSON object in it, as written, or null.

    Matching brackets is no regular pattern, so this is one of the few functions in Python.
    """
    kept = [c for c in df.columns if c not in (text, to)]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), f"`{to}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        decode = json.JSONDecoder().raw_decode
        for b in batches:
            out = []
            for t in b.column(b.schema.get_field_index(text)).to_pylist():
                found, at = None, (t or "").find("{")
                while at >= 0 and found is None:
                    try:
                        value, end = decode(t, at)
                        if isinstance(value, dict):
                            found = t[at:end]
                    except ValueError:
                        pass
                    at = t.find("{", at + 1)
                out.append(found)
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in kept], pa.array(out, pa.string())], names=[*kept, to])

    return df.select(*kept, F.col(text)).mapInArrow(run, schema)


def split_bundle(df: DataFrame, bundle: str) -> DataFrame:
    """review and revised (from ``revised_analysis`` or, in older answers, ``revised``) of a reviewer's answer."""
    schema = f"review struct<{_struct(REVIEW)}>, revised_analysis struct<{_struct(DOSSIER)}>, revised struct<{_struct(DOSSIER)}>"
    parsed = df.withColumn("__b", F.from_json(bundle, schema))
    return parsed.select(*[c for c in df.columns if c != bundle], F.col("__b.review").alias("review"), F.coalesce("__b.revised_analysis", "__b.revised").alias("revised"))


def _struct(ddl: str) -> str:
    from pyspark.sql.types import StructType

    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl))

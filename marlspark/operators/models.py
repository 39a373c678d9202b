"""A catalogue of papers with the files of every model, and metadata over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import blank

#: The suffixes that make no part of a name; the first that fits goes.
SUFFIXES = (".review.json", ".revised.json", ".json", ".pdf")
#: Models in the order in which their metadata count, and the fields of these.
MODELS = ("glm5.1", "gpt5.4")
FIELDS = ("title", "venue", "year", "authors")


def basename(file: Column) -> Column:
    name = file
    for s in reversed(SUFFIXES):
        name = F.when(file.endswith(s), F.substring(file, F.lit(1), F.length(file) - len(s))).otherwise(name)
    return name


def model_catalog(files: DataFrame, everything: bool = False) -> DataFrame:
    """basename, pdf, human and models: a map from model to its raw, review and revised file.

    ``files`` has area (pdf, llm or human), model (of llm alone) and file. Files with other suffixes than their area's don't count;
    of different files for one place, as repeated listings may give, the greatest name does. Only papers of some model
    are listed, unless ``everything`` is; the others have a null map. A null area, file or model of llm is no file.
    """
    pdf, human, llm = F.col("area") == "pdf", F.col("area") == "human", F.col("area") == "llm"
    json = F.col("file").endswith(".json")
    fits = (pdf & F.col("file").endswith(".pdf")) | (human & json) | (llm & json & F.col("model").isNotNull())
    kind = F.when(~llm, F.col("area")).when(F.col("file").endswith(".review.json"), "review").when(F.col("file").endswith(".revised.json"), "revised").otherwise("raw")
    known = files.where(fits).select(basename(F.col("file")).alias("basename"), F.when(llm, F.col("model")).alias("model"), kind.alias("kind"), "file")
    of = lambda k: F.max(F.when(F.col("kind") == k, F.col("file"))).alias(k)
    # Combined by model before any list is made, so a list is as long as there are models.
    places = known.groupBy("basename", "model").agg(*[of(k) for k in ("pdf", "human", "raw", "review", "revised")])
    entry = F.when(F.col("model").isNotNull(), F.struct("model", F.struct("raw", "review", "revised")))
    rows = places.groupBy("basename").agg(F.max("pdf").alias("pdf"), F.max("human").alias("human"), F.array_sort(F.collect_list(entry)).alias("__m"))
    rows = rows.select("basename", "pdf", "human", F.when(F.size("__m") > 0, F.map_from_entries("__m")).alias("models"))
    return rows if everything else rows.where("models IS NOT NULL")


def model_metadata(catalogue: DataFrame, documents: DataFrame, models: Sequence[str] = MODELS, fields: Sequence[str] = FIELDS) -> DataFrame:
    """basename and ``fields`` of each row of a catalogue, from the first of ``models`` whose document has a title.

    ``documents`` has model, file and text (JSON). A model is asked for its raw file, or for its revised one where the raw one is not listed
    or not there; what the file holds is not a reason to take the other. Where no model has a title the last document that is an object
    counts. Fields that a document lacks, or has as null, are blank; all are null where no document counts. Of repeated documents the
    greatest text counts.
    """
    asked = [F.struct(F.lit(m).alias("model"), F.lit(i).alias("nth"), F.lit(j).alias("kind"), F.col("models")[m][k].alias("file")) for i, m in enumerate(models) for j, k in enumerate(("raw", "revised"))]
    wanted = catalogue.select("basename", F.explode(F.array(*asked)).alias("x")).select("basename", "x.*").where("file IS NOT NULL")
    there = documents.where(F.col("model").isin(*models)).groupBy("model", "file").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    held = F.try_parse_json(F.col("text"))
    field = lambda f: F.coalesce(F.try_variant_get("v", f"$.{f}", "string"), F.lit("")).alias(f)
    read = there.withColumn("v", held).select("model", "file", F.when(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.struct(*[field(f) for f in fields])).alias("doc"))
    chosen = wanted.join(read, ["model", "file"]).groupBy("basename", "nth").agg(F.min_by("doc", "kind").alias("doc"))
    place = lambda when: F.when(when, F.col("nth"))
    best = F.coalesce(F.min_by("doc", place(~blank(F.col(f"doc.{fields[0]}")))), F.max_by("doc", place(F.col("doc").isNotNull())))
    found = chosen.groupBy("basename").agg(best.alias("__d"))
    return catalogue.select("basename").join(found, "basename", "left").select("basename", *[F.col(f"__d.{f}").alias(f) for f in fields])

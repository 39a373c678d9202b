"""Queries: what the writers write, read back by the readers. Files go to a folder of their own below the shared one."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import dedup as D
from ..operators import scoring as S
from ..schemas import DB, ENRICHED, strings
from ..sources import sinks, tables
from ..sources.shared import new_folder
from .base import Catalog, table

CATALOG = Catalog()


def folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return new_folder(spark, "roundtrip")


def _papers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"), F.col("text").alias("title"), F.col("lang").alias("year"), F.col("source").alias("venue"))


@CATALOG.query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, md5(coalesce(text, '')) AS title_md5, coalesce(lang, '') AS year, coalesce(source, '') AS venue, '' AS doi FROM documents")
def csv_round_trip(spark, sf_dir):
    """Texts with quotes, commas, line ends and spaces at their ends come back as they were; null comes back blank."""
    path = folder(spark)
    sinks.write_csv(_papers(spark, sf_dir), path, DB.fieldNames(), files=None)
    return tables.read_csv(spark, path, DB).select("paper_id", F.md5("title").alias("title_md5"), "year", "venue", "doi")


@CATALOG.query("SELECT paper_id, arg_min(f, f) AS file FROM (SELECT CAST(doc_id AS VARCHAR) AS paper_id, 1 AS f FROM documents UNION ALL SELECT CAST(doc_id AS VARCHAR), 0 FROM labels) GROUP BY paper_id")
def csv_files_first_wins(spark, sf_dir):
    """Files of a folder in order of their names, missing ones passed over; the first row of a key stays."""
    path = folder(spark)
    for name, rows in (("b", _papers(spark, sf_dir)), ("a", table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("paper_id")))):
        sinks.write_csv(rows.withColumn("title", F.lit("")), f"{path}/{name}", DB.fieldNames())
    parts = [tables.read_csv_if_there(spark, [f"{path}/{n}"], DB).withColumn("file", F.lit(i).cast("long")) for i, n in enumerate(("a", "b", "none"))]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return D.merge_tables(both, order=("file", "_row")).select("paper_id", "file")


@CATALOG.query("""
SELECT CAST(doc_id AS VARCHAR) AS paper_id, CASE WHEN doc_id % 3 = 2 THEN '' ELSE md5(coalesce(text, '')) END AS title_md5, CASE WHEN doc_id % 3 = 1 THEN '' ELSE coalesce(lang, '') END AS year,
  CASE WHEN doc_id % 3 = 2 THEN 'v2' ELSE coalesce(source, '') END AS venue, CASE doc_id % 3 WHEN 0 THEN '' ELSE '10.1/' || doc_id END AS doi FROM documents""")
def csv_by_header(spark, sf_dir):
    """Files of a folder with other orders of columns, missing and foreign ones, read as one table by their headers."""
    path = folder(spark)
    doi, rows = F.concat(F.lit("10.1/"), "paper_id"), _papers(spark, sf_dir)
    forms = [rows, rows.select("venue", doi.alias("doi"), "title", F.lit("foreign").alias("other"), "paper_id"), rows.select(F.lit("v1").alias("first"), doi.alias("doi"), F.lit("v2").alias("venue"), "paper_id", "year")]
    for i, form in enumerate(forms):
        own = form.where(F.col("paper_id").cast("long") % 3 == i)
        sinks.write_csv(own, f"{path}/{i}", [*form.columns, "url"], files=None)
    # A table without rows adds none.
    sinks.write_csv(forms[2].where("false"), f"{path}/empty", ["paper_id"])
    found = tables.read_csv(spark, [f"{path}/{x}" for x in ("0", "1", "2", "empty")], DB)
    return found.select("paper_id", F.when(F.col("title") == "", "").otherwise(F.md5("title")).alias("title_md5"), "year", "venue", "doi")


@CATALOG.query("SELECT source AS folder, CAST(doc_id AS VARCHAR) AS paper_id, md5(coalesce(text, '')) AS title_md5 FROM documents WHERE source IS NOT NULL")
def csv_folders(spark, sf_dir):
    """Tables found in a folder, by a pattern of names; other files there are passed over."""
    path = folder(spark)
    rows = _papers(spark, sf_dir).where("venue is not null")
    rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "paper_id", "venue")]).write.options(**sinks.CSV).csv(path)
    rows.select("paper_id").write.mode("append").option("header", "true").option("extension", "tsv").csv(path)
    found = tables.read_csv_folder(spark, path, DB)
    return found.select(F.col("venue").alias("folder"), "paper_id", F.md5("title").alias("title_md5"))


@CATALOG.query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, CASE WHEN quality = 1 THEN 'keep' ELSE '' END AS keep, 't' || toxic AS notes FROM labels")
def human_side_table(spark, sf_dir):
    """What people filled in, from the table where it is; a table that is not there has none."""
    path = folder(spark)
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("paper_id"), F.when(F.col("quality") == 1, "keep").alias("keep"), F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("notes"))
    sinks.write_csv(rows, f"{path}/there", ENRICHED.fieldNames())
    there, absent = (tables.human_columns(tables.read_csv_if_there(spark, [f"{path}/{n}"], ENRICHED)) for n in ("there", "absent"))
    return there.unionByName(absent)


@CATALOG.query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, lang AS year, source AS venue, CASE WHEN source = 'src1' THEN 'third' ELSE 'first' END AS run FROM documents")
def partitioned_output(spark, sf_dir):
    """Partitions that are there stay; forced ones are written anew, the others left alone."""
    path = folder(spark)
    rows = _papers(spark, sf_dir).drop("title")
    for run, part, force in (("first", rows, False), ("second", rows, False), ("third", rows.where("venue = 'src1'"), True)):
        sinks.write_partitioned(part.withColumn("run", F.lit(run)), path, ("venue", "year"), force)
    return spark.read.parquet(path).select("paper_id", F.col("year").cast("string").alias("year"), F.col("venue").cast("string").alias("venue"), "run")


@CATALOG.query("SELECT n.n AS list_size, CAST(doc_id AS VARCHAR) AS paper_id, n_chars AS relevance_score FROM (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents WHERE n_chars > 0) JOIN (VALUES (10), (50), (100)) n(n) ON place <= n.n")
def top_files(spark, sf_dir):
    """The three lists as files."""
    path = folder(spark)
    scored = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("paper_id"), F.col("n_chars").cast("long").alias("relevance_score"))
    found = None
    for n in sinks.write_tops(scored, path, ["paper_id", "relevance_score"], "doc_id"):
        rows = tables.read_csv(spark, f"{path}/top{n}", strings("paper_id relevance_score")).select(F.lit(n).cast("long").alias("list_size"), "paper_id", F.col("relevance_score").cast("long").alias("relevance_score"))
        found = rows if found is None else found.unionByName(rows)
    return found


@CATALOG.query("SELECT CASE WHEN doc_id % 2 = 0 THEN source || '-score-gte11.csv' ELSE source || '-top' || 25 || '.csv' END AS name, count(*) AS n FROM documents GROUP BY 1")
def derived_names(spark, sf_dir):
    """Names of slices, from the names of their tables."""
    docs = table(spark, sf_dir, "documents")
    names = {r[0]: (S.slice_name(f"{r[0]}.csv", min_score=11), S.slice_name(r[0] or "", top_n=25)) for r in docs.select("source").distinct().collect() if r[0] is not None}
    known = spark.createDataFrame([(k, i, v[i]) for k, v in names.items() for i in (0, 1)], "source string, i int, name string")
    return docs.withColumn("i", (F.col("doc_id") % 2).cast("int")).join(known, ["source", "i"], "left").groupBy("name").agg(F.count("*").alias("n"))


@CATALOG.query("SELECT 'https://doi.org/10.1/' || doc_id AS value FROM documents")
def text_lines(spark, sf_dir):
    path = folder(spark)
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"))
    sinks.write_lines(C.doi_lines(docs), path, files=None)
    return spark.read.text(path)


_RECORDS = "(SELECT d.doc_id, coalesce(d.text, '') AS body_text, l.doc_id IS NOT NULL AS csv_matched FROM documents d LEFT JOIN labels l USING (doc_id))"


@CATALOG.query(f"SELECT CAST(doc_id AS VARCHAR) AS file, md5(body_text) AS body_md5, length(body_text) AS text_length, csv_matched, (SELECT count(*) FILTER (csv_matched AND length(body_text) >= 200) FROM {_RECORDS}) AS all_success FROM {_RECORDS}")
def json_documents(spark, sf_dir):
    """Extracted documents with their index and summary, read back and joined."""
    path = folder(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body_text"))
    drafts = C.drafts(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", ["quality"])
    sinks.write_documents(drafts.select(F.col("doc_id").cast("string").alias("file"), "body_text", "text_length", "csv_matched", "extraction_status"), path)
    body = spark.read.schema("file string, body_text string").json(f"{path}/documents")
    index = tables.read_json_documents(spark, f"{path}/index", "file string, text_length long, csv_matched boolean", lines=True)
    summary = spark.read.schema("success long").json(f"{path}/summary")
    return body.join(index, "file").join(F.broadcast(summary)).select("file", F.md5("body_text").alias("body_md5"), "text_length", "csv_matched", F.col("success").alias("all_success"))


@CATALOG.query("SELECT user_id, arg_max(event_type, event_id) AS keep FROM events GROUP BY user_id")
def marks_log(spark, sf_dir):
    """Marks are appended and folded by key when read."""
    path = folder(spark)
    marks = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("keep"), "event_id")
    for late in (True, False):
        sinks.append_events(marks.where((F.col("keep") == "view") == late), path)
    return spark.read.parquet(path).transform(D.last_by("user_id", "event_id")).select("user_id", "keep")


@CATALOG.query("SELECT doc_id, right(coalesce(text, ''), 100) AS stdout_tail, right(source, 100) AS stderr_tail, quality = 0 OR toxic = 1 AS failed FROM documents JOIN labels USING (doc_id)")
def run_records(spark, sf_dir):
    """Status records keep the ends of long outputs; failed runs are also listed apart."""
    path = folder(spark)
    status = lambda c, bad: F.when(F.col(c) == bad, "failed").otherwise("completed")
    runs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.col("text").alias("stdout"), F.col("source").alias("stderr"), status("quality", 0).alias("analysis_status"), status("toxic", 1).alias("review_status"))
    sinks.write_status(runs, f"{path}/status", 100)
    sinks.write_run_summary(runs.select("doc_id", "analysis_status", "review_status"), path)
    records = spark.read.schema("doc_id long, stdout_tail string, stderr_tail string").json(f"{path}/status")
    everything = spark.read.schema("doc_id long").json(f"{path}/summary")
    failed = spark.read.schema("doc_id long").json(f"{path}/failed").withColumn("failed", F.lit(True))
    return records.join(everything, "doc_id").join(failed, "doc_id", "left").select("doc_id", "stdout_tail", "stderr_tail", F.coalesce("failed", F.lit(False)).alias("failed"))


@CATALOG.query("SELECT * FROM (VALUES ('bad', false, 1), ('good', true, 1)) t(kind, valid, files)")
def json_validity(spark, sf_dir):
    """Whether each JSON file of a folder parses, and that files are listed with their sizes."""
    path = folder(spark)
    for kind, value in (("good", F.to_json(F.struct("r_regionkey", "r_name"))), ("bad", F.concat(F.lit("{"), "r_name"))):
        first = table(spark, sf_dir, "region").orderBy("r_regionkey").limit(1)
        first.select(value.alias("value")).coalesce(1).write.option("lineSep", "\n").text(f"{path}/{kind}")
    found = None
    for kind in ("good", "bad"):
        names = tables.list_files(spark, f"{path}/{kind}", "part-*").where("length > 0")
        texts = spark.read.option("wholetext", True).text(f"{path}/{kind}").select(F.try_parse_json("value").isNotNull().alias("valid"))
        rows = names.agg(F.count("*").alias("files")).join(texts).select(F.lit(kind).alias("kind"), "valid", F.col("files").cast("int").alias("files"))
        found = rows if found is None else found.unionByName(rows)
    return found


@CATALOG.query("SELECT 'n' || n_nationkey || '-venue' AS id, CAST(y AS BIGINT) AS year, 2 AS weight FROM nation, range(2022, 2025) t(y)")
def configuration(spark, sf_dir):
    """A topic's and a venue list's configuration made of a table, written, and read through Spark."""
    path = folder(spark)
    key = F.col("n_nationkey").cast("string")
    venue = F.concat(F.lit("  - id: n"), key, F.lit("-venue\n    dblp_key: conf/n"), key, F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\n    dblp_abbr: a"), key)).otherwise(""))
    venues = table(spark, sf_dir, "nation").agg(F.array_join(F.sort_array(F.collect_list(venue)), "\n").alias("venues"))
    head = "topic: t\nkeywords:\n  - term: x\n    weight: 2\ndate_range:\n  start: 2022\n  end: 2024\nvenues:\n"
    sinks.write_lines(venues.select(F.concat(F.lit(head), "venues").alias("value")), path)
    config = tables.read_config(spark, path)
    weight = S.Topic.of(config).keywords[0][1]
    return tables.venue_years(spark, config, 2026).select("id", F.col("year").cast("long").alias("year"), F.lit(weight).cast("int").alias("weight"))

"""Readers: CSV tables with their order, topics, JSON documents, lookups, binary files."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Blank stays blank: null is a string that no file has.
CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000", "encoding": "UTF-8"}


def csv_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> list[str]:
    """The files that paths name: files, globs, or those of folders whose names fit ``pattern``; hidden ones are left out."""
    found = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for named in fs.globStatus(path) or []:
            inside = fs.listStatus(named.getPath()) if named.isDirectory() else [named]
            for f in inside:
                name = f.getPath().getName()
                if f.isFile() and name[:1] not in "_." and (not named.isDirectory() or fnmatchcase(name, pattern)):
                    found.append(f.getPath().toString())
    return found


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names in a file's first record, which may have line ends in quotes; none for an empty file. No more of the file is read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    io = spark._jvm.java.io
    lines = io.BufferedReader(io.InputStreamReader(p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p), "UTF-8"))
    try:
        text = line = lines.readLine()
        while line == "" or line is not None and text.count('"') % 2:  # blank lines before it are passed over
            line = lines.readLine()
            text = line if text == "" else f"{text}\n{line or ''}"
    finally:
        lines.close()
    return tuple(next(csv.reader([text.removeprefix("\ufeff")], strict=False), ())) if text else ()


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType, pattern: str = "*") -> DataFrame:
    """Rows of one file or more with ``_file`` and ``_row``, by which they stand in file order.

    Columns go by the names in each file's header, whatever their order: of names that repeat
    the last counts, names that ``schema`` lacks are left out, columns that a file lacks are
    blank (null if no string), and so are null the fields that a short row lacks. Files with the same header are one read.
    The driver reads one record of each file.
    """
    files = csv_files(spark, paths, pattern)
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(lambda f: csv_header(spark, f), files))
    reads = []
    for header in dict.fromkeys(h for h in headers if h):
        place = {name: i for i, name in enumerate(header)}
        kinds = {i: schema[name].dataType for name, i in place.items() if name in schema.fieldNames()}
        own = StructType([StructField(f"c{i}", kinds.get(i, StringType())) for i in range(len(header))])
        rows = spark.read.schema(own).options(**CSV).csv([f for f, h in zip(files, headers, strict=True) if h == header])
        lacks = lambda f: F.lit("" if isinstance(f.dataType, StringType) else None).cast(f.dataType)
        named = [(F.col(f"c{place[f.name]}") if f.name in place else lacks(f)).alias(f.name) for f in schema.fields]
        reads.append(rows.select(*named, F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_row")))
    if not reads:
        return spark.createDataFrame([], schema).select("*", F.lit("").alias("_file"), F.lit(0).cast("long").alias("_row"))
    return reduce(DataFrame.unionByName, reads)


def read_csv_if_there(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """As read_csv, of those paths that exist; no rows where none does."""
    return read_csv(spark, [p for p in paths if exists(spark, p)], schema)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv_folder(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.csv") -> DataFrame:
    return read_csv(spark, folder, schema, pattern)


def human_columns(rows: DataFrame) -> DataFrame:
    """The side table of what people filled in: paper_id, keep, notes."""
    return rows.select("paper_id", "keep", "notes").where("paper_id != ''")


def parse_config(text: str) -> dict:
    """A YAML or JSON configuration; YAML needs the yaml package or the plain subset read here.

    The subset: nested maps, lists of scalars or of one-line or indented maps, comments, quotes.
    """
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        return _parse_block([(len(x) - len(x.lstrip()), x.strip()) for x in map(_bare, text.splitlines()) if x.strip()])


def _bare(line: str) -> str:
    return re.sub(r"""(^|\s)#(?=[^"']*(?:["'][^"']*["'][^"']*)*$).*$""", "", line)


def _scalar(s: str):
    s = s.strip()
    if len(s) > 1 and s[0] == s[-1] and s[0] in "\"'":
        return s[1:-1]
    if s.startswith("{") and s.endswith("}"):
        return {k.strip(): _scalar(v) for k, _, v in (p.partition(":") for p in s[1:-1].split(","))}
    if s.startswith("[") and s.endswith("]"):
        return [_scalar(x) for x in s[1:-1].split(",") if x.strip()]
    if re.fullmatch(r"-?\d+", s):
        return int(s)
    if re.fullmatch(r"-?\d+\.\d+", s):
        return float(s)
    return {"true": True, "false": False, "null": None, "~": None, "": None}.get(s, s)


def _parse_block(lines: list[tuple[int, str]]):
    if not lines:
        return {}
    depth = lines[0][0]
    if lines[0][1].startswith("- ") or lines[0][1] == "-":
        out, i = [], 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and lines[j][0] > depth:
                j += 1
            head = lines[i][1][1:].strip()
            if re.match(r"[^\"'{\[][^:]*:(\s|$)", head):
                out.append(_parse_block([(depth + 2, head), *((max(d, depth + 2) if d == depth + 2 else d, t) for d, t in lines[i + 1 : j])]))
            else:
                out.append(_scalar(head))
            i = j
        return out
    out, i = {}, 0
    while i < len(lines):
        j = i + 1
        while j < len(lines) and (lines[j][0] > depth or lines[j][0] == depth and lines[j][1].startswith("-")):
            j += 1
        key, _, value = lines[i][1].partition(":")
        out[_scalar(key)] = _scalar(value) if value.strip() else (_parse_block(lines[i + 1 : j]) if j > i + 1 else None)
        i = j
    return out


def read_config(spark: SparkSession, path: str) -> dict:
    """A small configuration file, read through Spark so that any store will do."""
    return parse_config("\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect()))


def venue_years(spark: SparkSession, config: dict, this_year: int) -> DataFrame:
    """id, key, abbr and year of every venue in the configured range (2020 to this year by default)."""
    span = config.get("date_range") or {}
    rows = [(v["id"], v["dblp_key"], v.get("dblp_abbr") or v["dblp_key"].rpartition("/")[2]) for v in config.get("venues") or ()]
    df = spark.createDataFrame(rows, "id string, key string, abbr string")
    return df.withColumn("year", F.explode(F.sequence(F.lit(int(span.get("start", 2020))), F.lit(int(span.get("end", this_year))))))


def page_candidates(venues: DataFrame, suffixes: int = 4) -> DataFrame:
    """URLs to try for each venue and year: the plain page, else -1, -2, ... up to the first gap."""
    rows = venues.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(suffixes))))
    tail = F.when(F.col("part") == 0, "").otherwise(F.concat(F.lit("-"), F.col("part").cast("string")))
    return rows.withColumn("url", F.concat(F.lit("https://dblp.org/db/"), "key", F.lit("/"), "abbr", F.col("year").cast("string"), tail, F.lit(".html")))


def until_gap(fetched: DataFrame, key: list[str]) -> DataFrame:
    """Pages in use: the plain one alone if it was found, else the suffixed ones before the first that was not."""
    from pyspark.sql import Window

    w = Window.partitionBy(*key)
    plain = F.max(F.when(F.col("part") == 0, F.col("ok"))).over(w)
    suffixed = fetched.where("part > 0").withColumn("__run", F.min(F.col("ok").cast("int")).over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))
    marked = fetched.withColumn("__plain", F.coalesce(plain, F.lit(False)))
    first = marked.where("part = 0 and ok").drop("__plain")
    rest = suffixed.join(marked.where("not __plain").select(*key).distinct(), key, "left_semi").where("__run = 1").drop("__run")
    return first.unionByName(rest)


def fetch_pages(urls: DataFrame, get: Callable[[str], str], url: str = "url", retries: int = 3, wait: float = 2.0) -> DataFrame:
    """url, html, ok: pages by a caller's function, tried again with a linear wait; failures are rows, not errors.

    An error with a ``code`` is tried again for the codes of PAGE_AGAIN only; broken connections and half answers always.
    """

    def run(batches: Iterator) -> Iterator:
        import time
        from http.client import IncompleteRead

        from .services import NETWORK, page_wait

        import pyarrow as pa

        for b in batches:
            pages, ok = [], []
            for u in b.column(0).to_pylist():
                page = None
                for attempt in range(retries + 1):
                    try:
                        page = get(u)
                        break
                    except (OSError, IncompleteRead) as failed:
                        pause = page_wait(getattr(failed, "code", None) or NETWORK, attempt, retries)
                        if pause is None:
                            break
                        time.sleep(pause * wait / 2)
                pages.append(page)
                ok.append(page is not None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pages, pa.string()), pa.array(ok)], names=["url", "html", "ok"])

    return urls.select(F.col(url).alias("url")).mapInArrow(run, "url string, html string, ok boolean")


def lookup_batches(ids: DataFrame, get: Callable[[list[str]], list[dict | None]], schema: str, column: str = "id", size: int = 500) -> DataFrame:
    """Rows found for ids by a caller's function, ``size`` ids a call and answers in the order asked; None is not found.

    Fewer partitions make fewer concurrent callers: repartition ``ids`` to set a rate.
    """
    from pyspark.sql.types import StructType as Struct

    names = Struct.fromDDL(schema).fieldNames()

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        waiting: list[str] = []

        def flush(chunk: list[str]) -> pd.DataFrame:
            rows = [{column: i, **r} for i, r in zip(chunk, get(chunk), strict=True) if r]
            return pd.DataFrame(rows, columns=names).astype(object)

        for f in frames:
            waiting += f[column].tolist()
            while len(waiting) >= size:
                yield flush(waiting[:size])
                waiting = waiting[size:]
        if waiting:
            yield flush(waiting)

    return ids.select(F.col(column)).mapInPandas(run, schema)


def parse_atom(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """id, title, summary, published, authors, categories of the entries of stored Atom feeds."""
    bare = F.regexp_replace(F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"', ""), r"<(/?)\w+:(\w+)", "<$1$2")
    entry = F.explode(F.regexp_extract_all(bare, F.lit(r"(?s)<entry>.*?</entry>"), F.lit(0))).alias("e")
    rows = feeds.select(*[c for c in feeds.columns if c != xml], entry)
    field = lambda n: F.trim(F.regexp_replace(F.expr(f"xpath_string(e, 'entry/{n}')"), r"\s+", " ")).alias(n)
    return rows.select(*[c for c in feeds.columns if c != xml], field("id"), field("title"), field("summary"), F.substring(F.expr("xpath_string(e, 'entry/published')"), 1, 10).alias("published"), F.expr("xpath(e, 'entry/author/name/text()')").alias("authors"), F.expr("xpath(e, 'entry/category/@term')").alias("categories"))


def read_json_documents(spark: SparkSession, folder: str, schema: str | StructType, leave_out: Iterable[str] = ("index.json",), lines: bool = False) -> DataFrame:
    """One document a file, or with ``lines`` one a line; index files left out, with its ``file_name``."""
    rows = spark.read.schema(schema).option("multiLine", not lines).option("pathGlobFilter", "*.json").json(folder)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name")).where(~F.col("file_name").isin(*leave_out))


def read_variants(spark: SparkSession, folder: str) -> DataFrame:
    """file, value and valid of every JSON file: unparsable ones have a null value."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(folder)
    parsed = F.try_parse_json("value")
    return rows.select(F.col("_metadata.file_name").alias("file"), parsed.alias("value"), parsed.isNotNull().alias("valid"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, name and length; contents aren't read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def read_pdfs(spark: SparkSession, folder: str, extract: Callable[[bytes], list[str]], least: int = 200, least_bytes: int = 10_240) -> DataFrame:
    """path and text of PDF files by a caller's extractor, which returns texts by preference.

    A text under ``least`` characters has the next extractor's appended; if it is still
    shorter it is blank. Files under ``least_bytes`` are left out.
    """
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder).where(F.col("length") >= least_bytes)

    def run(frames: Iterator) -> Iterator:
        for f in frames:
            texts = []
            for content in f["content"]:
                text = ""
                for more in extract(content):
                    text = f"{text}\n{more}" if text else more
                    if len(text.strip()) >= least:
                        break
                texts.append(text if len(text.strip()) >= least else "")
            yield f[["path"]].assign(text=texts)

    return rows.select("path", "content").mapInPandas(run, "path string, text string")

"""Small helpers that the operators share: tables, lineage cuts, row keys, Arrow chunks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that an Arrow function works on at a time; one longer text makes a chunk alone.
CHUNK_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    A temporary one is made only in a local session that names none (tests, one
    machine); on a cluster without the setting this raises.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp("-checkpoints")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Where a ``Store`` writes, if not in the shared folder itself.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, folder: str) -> Iterator[None]:
    """Each ``Store`` made within writes below ``folder``, which goes at the end: what was made from its tables must be written by then."""
    before = _SCRATCH.set(folder)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        delete(spark, folder)


class Store:
    """Tables of one run, written as Parquet below the shared folder and read again; those no longer needed are deleted.

    What is still read when the run's result is made stays, but for a caller's ``scratch``.

    ``steady`` is a session beside the caller's, without adaptive re-planning: for
    loops of small steps, whose many plans would fill the driver. The caller's
    settings are not touched.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.made = spark, f"{_SCRATCH.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.kept: dict[int, tuple[DataFrame, str]] = {}
        self.steady = spark.newSession()
        self.steady.conf.set("spark.sql.adaptive.enabled", "false")

    def keep(self, df: DataFrame, steady: bool = False) -> DataFrame:
        path, self.made = f"{self.base}/{self.made}", self.made + 1
        # Without dictionaries, for Spark broadcasts by size of files: runs of numbers would take far less there than in memory.
        df.write.option("parquet.enable.dictionary", "false").parquet(path)
        read = (self.steady if steady else self.spark).read.schema(df.schema).parquet(path)
        self.kept[id(read)] = read, path
        return read

    def path(self, table: DataFrame) -> str:
        return self.kept[id(table)][1]

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, self.kept.pop(id(t))[1])


def doc_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """A document's identity: its id or, where that is null, a hash of its text."""
    return F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.lit(17), F.col(text)))


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The same for rows with equal id and text, which every operator treats alike."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text), F.col(doc_id).isNull(), F.col(text).isNull())


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def packed(df: DataFrame, *columns: str | Column, out: str | None = None) -> DataFrame:
    """``df`` as one struct ``__row``, beside copies of the named columns: no other column can clash.

    The column ``out`` is left out of the struct, for texts that need not travel twice; see ``unpacked``.
    """
    inside = [F.col(f"`{c}`") for c in df.columns if c != out] or [F.lit(None).alias("none")]
    return df.select(F.struct(*inside).alias("__row"), *columns)


def unpacked(df: DataFrame, columns: list[str], out: str = "text") -> DataFrame:
    """The ``columns`` again, ``out`` from ``__text``."""
    return df.select(*[F.col("__text").alias(c) if c == out else F.col(f"__row.`{c}`").alias(c) for c in columns])


def chunks(texts: list[str], most: int = CHUNK_CHARS, count: int = 1 << 14) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive runs of ``texts`` of about ``most`` characters and at most ``count`` texts each."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > most or i - start >= count):
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def map_texts(df: DataFrame, fn: Callable[[list[str]], dict[str, list]], schema: str, text: str = "text", count: int = 1 << 14, keep: bool = False) -> DataFrame:
    """Add what ``fn`` makes of each row's text; the text itself is dropped unless ``keep``, other columns stay but for those of the new names.

    ``fn`` gets whole texts (null as ""), at most ``count`` in a chunk, and returns Arrow arrays or
    lists by column. No shuffle; memory is bounded by a batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(schema).fieldNames()
    kept = [c for c in df.columns if (keep or c != text) and c not in made]
    full = StructType([df.schema[c] for c in kept] + StructType.fromDDL(schema).fields)
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            rest = b.select(kept) if kept else None
            for i, j in chunks(texts, count=count):
                out = fn(texts[i:j])
                columns = [rest.column(k).slice(i, j - i) for k in range(len(kept))]
                for n in made:
                    kind = arrow.field(n).type
                    columns.append(out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], type=kind))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, full)

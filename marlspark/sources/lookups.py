"""Lookups as a data source: ids kept as Parquet go in, a service's answers come out.

    spark.dataSource.register(lookup_format("papers", get, "id string, title string"))
    spark.read.format("papers").option("path", ids).load()

A partition is a row group of the ids, so the driver plans from the files' footers and holds no id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from .services import RateLimit

Get = Callable[[list], list[dict | None]]


@dataclass
class Group(InputPartition):
    """One row group of ids, and how often its task may call in a second (0: as it likes)."""

    file: str
    group: int
    rate: float


class Ids:
    """The files of ids, by name, and their row groups."""

    def __init__(self, options: dict[str, str]):
        from pyarrow import fs

        self.column, self.rate, self.slots = options.get("column", "id"), float(options.get("rate", 0)), int(options.get("slots", 0))
        self.fs, self.root = fs.FileSystem.from_uri(re.sub("^file:/+", "/", options["path"]))

    def files(self) -> list[str]:
        from pyarrow import fs

        if self.fs.get_file_info(self.root).type == fs.FileType.File:
            return [self.root]
        found = self.fs.get_file_info(fs.FileSelector(self.root, recursive=True))
        return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet") and not re.search("(^|/)[._]", f.path[len(self.root) :]))

    def groups(self, files: list[str], wanted: set | None = None) -> list[Group]:
        """Row groups, without those whose least and greatest id tell that no wanted id is there."""
        import pyarrow.parquet as pq

        found = []
        for f in files:
            meta = pq.read_metadata(f, filesystem=self.fs)
            at = meta.schema.to_arrow_schema().get_field_index(self.column)
            if at < 0:
                raise ValueError(f"{f} has no column {self.column}")
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(at).statistics
                if meta.row_group(g).num_rows and (wanted is None or s is None or not s.has_min_max or any(s.min <= w <= s.max for w in wanted)):
                    found.append((f, g))
        return [Group(f, g, self.rate / (min(len(found), self.slots) if self.slots else len(found))) for f, g in found]

    def chunks(self, p: Group, size: int, wanted: set | None) -> Iterator[list]:
        import pyarrow.parquet as pq

        waiting: list = []
        with self.fs.open_input_file(p.file) as f:
            for b in pq.ParquetFile(f).iter_batches(size, [p.group], [self.column]):
                waiting += [i for i in b.column(0).to_pylist() if i is not None and (wanted is None or i in wanted)]
                while len(waiting) >= size:
                    yield waiting[:size]
                    waiting = waiting[size:]
        if waiting:
            yield waiting


class Answers:
    """What batch and stream readers share: the calls of one partition."""

    def __init__(self, source: Lookups, schema: StructType):
        self.get, self.size, self.key, self.answer, self.options, self.wanted = source.get_answers, source.size, source.key, schema, dict(source.options), None

    def read(self, partition: Group | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # Spark's stand-in where there is nothing to read
            return
        schema, limit = to_arrow_schema(self.answer), RateLimit(partition.rate) if partition.rate else None
        for chunk in Ids(self.options).chunks(partition, self.size, self.wanted):
            asked = list(dict.fromkeys(chunk))
            if limit:
                limit.wait()
            found = dict(zip(asked, self.get(asked), strict=True))
            rows = [{**found[i], self.key: i} for i in chunk if found[i] is not None]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class Batch(Answers, DataSourceReader):
    def partitions(self) -> list[Group]:
        ids = Ids(self.options)
        return ids.groups(ids.files(), self.wanted)


class Filtered(Batch):
    """A class of its own, as Spark refuses readers with this method where its setting is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Equality and membership of the id choose what is asked for; all else is left to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and tuple(f.attribute) == (self.key,):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f


class Stream(Answers, DataSourceStreamReader):
    """Files in order of their names; the offset is the last name, so a restart asks only for files after those committed."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"file": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"file": max(Ids(self.options).files(), default="")}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        ids = Ids(self.options)
        return ids.groups([f for f in ids.files() if start["file"] < f <= end["file"]])


class Lookups(DataSource):
    get_answers: Get
    size: int
    key: str

    def reader(self, schema: StructType) -> Batch:
        return (Filtered if self.options.get("filters", "").lower() == "true" else Batch)(self, schema)

    def streamReader(self, schema: StructType) -> Stream:  # noqa: N802
        return Stream(self, schema)


def lookup_format(name: str, get: Get, schema: str, key: str = "id", size: int = 500) -> type[DataSource]:
    """A format for ``spark.dataSource.register``: the answers of ``get`` to at most ``size`` different ids a call, in the order asked; None is not found.

    Options: ``path`` of Parquet files of ids, their ``column`` (id), ``rate`` (calls a second by all tasks together, each partition having an
    equal share; unset: no limit), ``slots`` (tasks that run at a time, where they are fewer than partitions) and ``filters``. Every id listed gives a row if it
    is found, repeated ones too; null ids are not asked. ``get`` may run again for ids of a task that failed. With ``filters``
    true, which needs ``spark.sql.python.filterPushdown.enabled``, a filter for single ids keeps other row groups from being read and other ids from being asked.
    A stream takes files in order of name: later files need later names.
    """
    members = {"name": classmethod(lambda cls: name), "schema": lambda self: schema, "get_answers": staticmethod(get), "size": size, "key": key}
    return type("LookupFormat", (Lookups,), members)

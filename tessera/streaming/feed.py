"""Streaming feed of the rows appended to a stored table.

A Python data source over the numbered pointers of a ``VersionedTable`` (or ``KeyedTable``):
an offset is a version, the first batch holds everything since the table's creation, and each
later one the segment files that the versions after the last offset added.  Offsets are kept by
the query's checkpoint, so a restart goes on with the next version.  A version that replaced
rows cannot be told as appended rows and stops the query; versions have to outlive the
queries that still need them (see ``VersionedTable.vacuum``).

The pointers are read where the query is planned; files are read by the tasks, one for
each file, as Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tessera.session import ship_package
from tessera.sources.tables import Rewritten

NAME = "table_feed"


def _store(path: str):
    """File system and path within it; Hadoop writes local URIs with a single slash."""
    from pyarrow import fs

    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class _File(InputPartition):
    path: str


class _Pointers:
    """Versions of a table, read without a Spark session."""

    def __init__(self, path: str):
        self.store, self.path = _store(path)

    def _names(self, folder: str, kind) -> list[str]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.path}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == kind and not f.base_name.startswith((".", "_")))

    def latest(self) -> int:
        from pyarrow import fs

        names = [n for n in self._names("_pointer", fs.FileType.File) if n.startswith("v") and n.endswith(".json")]
        return int(names[-1][1:-5]) if names else 0

    def state(self, version: int) -> dict:
        with self.store.open_input_stream(f"{self.path}/_pointer/v{version:012d}.json") as f:
            return json.loads(f.read())

    def folders(self, state: dict) -> list[str]:
        return [f"{e['seg']}/_bucket={e['bucket']}" for e in state["entries"]] if "entries" in state else state["segments"]

    def files(self, folder: str) -> list[str]:
        from pyarrow import fs

        return [f"{folder}/{n}" for n in self._names(folder, fs.FileType.File) if n.endswith(".parquet")]


class FeedReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": _Pointers(self.path).latest()}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        pointers, first, last = _Pointers(self.path), int(start["version"]), int(end["version"])
        if last <= first:
            return []
        for version in range(first + 1 if first else 2, last + 1):  # a table's first version only adds
            if not pointers.state(version).get("appends"):
                raise Rewritten(f"{self.path}: version {version} replaced rows")
        before = set(pointers.folders(pointers.state(first))) if first else set()
        new = [d for d in pointers.folders(pointers.state(last)) if d not in before]
        return [_File(f) for d in new for f in pointers.files(d)]

    def read(self, partition: _File) -> Iterator:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        pointers, wanted = _Pointers(self.path), to_arrow_schema(self.schema)
        with pointers.store.open_input_file(f"{pointers.path}/{partition.path}") as raw:
            for batch in pq.ParquetFile(raw).iter_batches(columns=wanted.names):
                yield batch.select(wanted.names).cast(wanted)

    def commit(self, end: dict) -> None:
        """Nothing to do: the query's checkpoint keeps the offset."""


class TableFeed(DataSource):
    """``spark.readStream.format("table_feed").load(<path of the table>)``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        pointers = _Pointers(self.options["path"])
        if not pointers.latest():
            raise ValueError(f"{self.options['path']} has no committed version yet")
        return StructType.fromJson(json.loads(pointers.state(pointers.latest())["schema"]))

    def streamReader(self, schema: StructType) -> FeedReader:
        return FeedReader(self.options["path"], schema)


def appended(spark: SparkSession, path: str) -> DataFrame:
    """Streaming frame of the rows appended to the table at ``path`` since its creation."""
    ship_package(spark)
    spark.dataSource.register(TableFeed)
    return spark.readStream.format(NAME).load(path)


def copy_available(spark: SparkSession, path: str, sink: str, checkpoint: str) -> None:
    """Append what the feed has now to a parquet sink, then stop; a later call goes on from there."""
    query = (appended(spark, path).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()

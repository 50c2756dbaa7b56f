"""A folder that takes rows in batches, each load whole and once, and gives back columns by pushed filters.

Tasks write into files of their own and report them to the driver. Only when all tasks of a load have ended does the
driver publish their names; a task that is repeated reports new files, and those of its earlier attempt stay unnamed.
A load with a name that is published already adds nothing. Files are written through Arrow's file systems, so the folder
may be local, on HDFS or in an object store; all executors have to reach it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

FORMAT = "batch_folder"
PUBLISHED, STAGED = "published", "staged"
BATCH_ROWS = 1_000


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and the path within it; ``file:/x`` counts as a local path."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _names(system: fs.FileSystem, folder: str) -> list[str]:
    return sorted(i.path for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.type == fs.FileType.File)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written."""

    files: list[str] = field(default_factory=list)
    rows: int = 0


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.schema = options["path"], schema
        self.batch_rows = int(options.get("batch_rows", BATCH_ROWS))
        self.load = options.get("load") or uuid.uuid4().hex
        self.run = uuid.uuid4().hex  # two runs of one load stage their files apart

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file for each task, one row group for each batch; nothing without rows."""
        system, root = open_folder(self.path)
        folder = f"{root}/{STAGED}/{self.load}-{self.run}"
        name = f"{folder}/{uuid.uuid4().hex}.parquet"
        rows, waiting, sink = 0, [], None
        try:
            for received in iterator:
                waiting.append(received)
                while (count := sum(b.num_rows for b in waiting)) >= self.batch_rows:
                    sink = sink or self._open(system, folder, name, received.schema)
                    rest = pa.Table.from_batches(waiting)
                    sink.write_table(rest.slice(0, self.batch_rows), row_group_size=self.batch_rows)
                    rows, waiting = rows + self.batch_rows, rest.slice(self.batch_rows).to_batches()
            if count := sum(b.num_rows for b in waiting):
                sink = sink or self._open(system, folder, name, waiting[0].schema)
                sink.write_table(pa.Table.from_batches(waiting), row_group_size=self.batch_rows)
                rows += count
            if sink is not None:
                sink.close()
        except BaseException:
            if sink is not None:
                sink.close()
                system.delete_file(name)
            raise
        return Written([name] if rows else [], rows)

    @staticmethod
    def _open(system: fs.FileSystem, folder: str, name: str, schema: pa.Schema) -> pq.ParquetWriter:
        system.create_dir(folder, recursive=True)
        return pq.ParquetWriter(name, schema, filesystem=system)

    def commit(self, messages: list[Written | None]) -> None:
        """Publishes the files of all tasks under the name of the load, unless it has been published before."""
        system, root = open_folder(self.path)
        done = [m for m in messages if m is not None]
        target = f"{root}/{PUBLISHED}/{self.load}.json"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(messages)
            return
        system.create_dir(f"{root}/{PUBLISHED}", recursive=True)
        listed = {"load": self.load, "files": [f for m in done for f in m.files], "rows": sum(m.rows for m in done)}
        hidden = f"{root}/{PUBLISHED}/.{self.load}-{self.run}"
        with system.open_output_stream(hidden) as out:
            out.write(json.dumps(listed).encode())
        system.move(hidden, target)

    def abort(self, messages: list[Written | None]) -> None:
        """Removes what the tasks have written."""
        system, _ = open_folder(self.path)
        for message in messages:
            for name in message.files if message is not None else ():
                system.delete_file(name)


COMPARED = {
    EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less,
    LessThanOrEqual: pc.less_equal,
}


def as_expression(pushed: Filter) -> pc.Expression | None:
    """The filter for the reader of files; None for one that Spark has to apply itself."""
    if len(pushed.attribute) != 1:  # a field inside a struct
        return None
    column = pc.field(pushed.attribute[0])
    if type(pushed) in COMPARED:
        return COMPARED[type(pushed)](column, pa.scalar(pushed.value))
    if isinstance(pushed, In):
        return column.isin(list(pushed.value))
    if isinstance(pushed, IsNotNull):
        return column.is_valid()
    return column.is_null() if isinstance(pushed, IsNull) else None


class BatchReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.columns, self.pushed = options["path"], schema.names, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes the filters that files can be asked for; gives back the others."""
        for pushed in filters:
            expression = as_expression(pushed)
            if expression is None:
                yield pushed
            else:
                self.pushed.append(expression)

    def partitions(self) -> list[InputPartition]:
        system, root = open_folder(self.path)
        found = []
        for name in _names(system, f"{root}/{PUBLISHED}"):
            if name.endswith(".json"):
                with system.open_input_stream(name) as listed:
                    found += [InputPartition(file) for file in json.loads(listed.read())["files"]]
        return found or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """Row groups that the filters leave, in the columns that are asked for."""
        if partition.value is None:
            return
        system, _ = open_folder(self.path)
        wanted = None
        for expression in self.pushed:
            wanted = expression if wanted is None else wanted & expression
        yield from ds.dataset(partition.value, filesystem=system, format="parquet").to_batches(columns=self.columns, filter=wanted)


class BatchFolder(DataSource):
    """Options: ``path``, ``batch_rows``, and ``load``, the name under which a load is published once."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give the schema: spark.read.format(...).schema(...)")

    def reader(self, schema: T.StructType) -> BatchReader:
        return BatchReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("loads are appended")
        return BatchWriter(dict(self.options), schema)


def insert_once(df: DataFrame, path: str, load: str, batch_rows: int = BATCH_ROWS) -> None:
    """Send rows, nested arrays included, in batches from the executors that hold them; each load is stored once."""
    df.sparkSession.dataSource.register(BatchFolder)
    df.write.format(FORMAT).option("batch_rows", batch_rows).option("load", load).mode("append").save(path)


def stored_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of all published loads. Filters and columns go to the files: nothing else is read and sent to Spark."""
    spark.dataSource.register(BatchFolder)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).schema(schema).load(path)

"""File inventories listed by the executors: one task for each folder right below the root.

The driver lists one level only, and no file is opened. Reaches what Arrow's file systems reach; for other stores there
is ``inventory.file_inventory``, which lists on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gamegrain.sinks.batches import open_folder

FORMAT = "file_listing"
SCHEMA = "folder string, path string, name string, modified_at timestamp, length bigint"
ENDINGS = (".parquet", ".json")
ROWS = 10_000


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


class ListingReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        """The root's own files, and each folder below it."""
        system, root = open_folder(self.path)
        below = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        folders = sorted(i.base_name for i in below if i.type == fs.FileType.Directory and not _hidden(i.base_name))
        return [InputPartition(""), *map(InputPartition, folders)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(self.path)
        folder, base = partition.value, f"{root}/{partition.value}".rstrip("/")
        found = system.get_file_info(fs.FileSelector(base, recursive=folder != "", allow_not_found=True))
        files = [
            i for i in found if i.type == fs.FileType.File and i.base_name.endswith(ENDINGS)
            and not any(map(_hidden, i.path.removeprefix(root).strip("/").split("/")))
        ]
        for at in range(0, len(files), ROWS):
            part = files[at : at + ROWS]
            times = pa.array([i.mtime.astimezone(timezone.utc) for i in part], pa.timestamp("us", "UTC"))
            names = [[folder] * len(part), [i.path for i in part], [i.base_name for i in part]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, names), times, pa.array([i.size for i in part], pa.int64())],
                names=["folder", "path", "name", "modified_at", "length"],
            )


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> ListingReader:
        return ListingReader(self.options["path"])


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per Parquet or JSON file below a folder: the folder right below the root, path, name, time, length."""
    spark.dataSource.register(FileListing)
    return spark.read.format(FORMAT).load(folder)


def stored_folders(files: DataFrame) -> DataFrame:
    """Names of the folders right below the root that hold a file."""
    return files.where("folder <> ''").select("folder").distinct()


def newest_snapshot(spark: SparkSession, path: str, schema: T.StructType, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot, told by the names of the ``snapshot=value`` folders; no other folder is read.

    Values are compared as text, so they have to sort as such (ISO dates do). Without a folder: no rows.
    """
    folders = stored_folders(listed_files(spark, path)).where(F.col("folder").startswith(f"{snapshot}="))
    newest = folders.agg(F.max("folder")).first()[0]
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{newest}")

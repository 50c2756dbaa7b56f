"""What lies on storage: files, keys in paths, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One row per Parquet or JSON file below a folder: path, name, modification time, length.

    The binary source reads file contents only when asked for ``content``, so this lists and opens nothing.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{parquet,json}")
        .load(folder)
    )
    return files.select(
        F.col("path"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length"),
    )


def wanted_files(inventory: DataFrame, wanted: DataFrame, name: str = "name") -> DataFrame:
    """Files of the inventory whose name is in a list of wanted ones."""
    return inventory.join(wanted.select(F.col(name).alias("name")).distinct(), "name", "left_semi")


def newest_file(inventory: DataFrame) -> DataFrame:
    """One row: the path changed last and its time; both NULL on an empty folder. Equal times: last path."""
    newest = F.max(F.struct("modified_at", "path"))
    return inventory.agg(newest.alias("newest")).select("newest.path", "newest.modified_at")


def folder_keys(inventory: DataFrame, root: str) -> DataFrame:
    """Names of the folders right below ``root`` that hold a file."""
    below = F.regexp_extract(F.col("path"), r"^.*?" + _quoted(root.rstrip("/")) + r"/([^/]+)/", 1)
    return inventory.select(below.alias("folder")).where("folder != ''").distinct()


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot. The scalar subquery becomes a partition filter on a partitioned folder."""
    return df.where(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


def _quoted(text: str) -> str:
    """Literal text inside a Java regular expression."""
    return r"\Q" + text.replace("file://", "").replace(r"\E", r"\E\\E\Q") + r"\E"

"""Feed scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamegrain.functions.nested import flatten_schema, nest_schema
from gamegrain.sources.feeds import document_schema, landed_schema

# Metadata column of Spark's file sources; asked for only where the path carries a key.
FILE_PATH = "_metadata.file_path"


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """File, folder, glob or list of paths; columns a file lacks come back NULL."""
    return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))


def read_feed(spark: SparkSession, path: str | list[str], feed: str, *extra: str) -> DataFrame:
    """A landed feed. ``extra`` names partition or key columns of the layout, as DDL (``'game_id bigint'``)."""
    schema = landed_schema(feed)
    for column in extra:
        name, kind = column.split(" ", 1)
        schema = schema.add(name, kind)
    return read_parquet(spark, path, schema)


def only_keyed(documents: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Documents whose key is wanted.

    A semi join, not a list in the plan: with ``on`` a partition column Spark prunes partitions at run time, and the
    number of keys may grow without passing the driver.
    """
    return documents.join(keys.select(*on).distinct(), list(on), "left_semi")


def read_json_documents(spark: SparkSession, path: str | list[str], feed: str, multiline: bool = True) -> DataFrame:
    """Raw JSON documents of a feed → one flat row each, dotted column names, arrays kept, plus ``file_path``.

    Fields declared as text keep the JSON text of whatever stands there (numbers, nested lists), which homogenises
    mixed values and serialises the drifting part in one go.
    """
    nested = nest_schema(document_schema(feed))
    documents = spark.read.schema(nested).json(path, multiLine=multiline)
    return documents.select(*flatten_schema(nested), F.col(FILE_PATH).alias("file_path"))


def flatten(df: DataFrame) -> DataFrame:
    """Any frame with structs → flat columns with dotted names, arrays kept."""
    return df.select(*flatten_schema(df.schema))

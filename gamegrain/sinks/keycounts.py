"""Exact distinct counts that are kept for each load and merged without reading its rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamegrain.sinks.tables import read_or_empty

SCHEMA = "bucket bigint, bits binary, load string"


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """Bitmaps of the whole-number keys of a frame, one of 4 KB for each stretch of 32,768 values that occurs."""
    keys = df.select(F.col(key).cast("bigint").alias("key")).dropna()
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("key"))
    return keys.groupBy(F.bitmap_bucket_number("key").alias("bucket")).agg(bits.alias("bits"))


def merged(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of all keys in any of the given ones."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_keys(bitmaps: DataFrame, name: str = "keys") -> DataFrame:
    """Number of different keys as a one-row frame."""
    return merged(bitmaps).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def store_keys(df: DataFrame, path: str, key: str, load: str) -> None:
    """Keeps the bitmaps of a load below ``path``; a load that is stored again takes the place of its first one."""
    rows = key_bitmaps(df, key).withColumn("load", F.lit(load))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load").parquet(path)


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SCHEMA)

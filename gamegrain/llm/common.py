"""What the operators share: session settings, row numbers, gapless places."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamegrain.session import scratch_path

# Rows per Arrow batch: whole texts of a few hundred kilobytes each still make batches of tens of megabytes.
BATCH_ROWS = 512
ROWS_PER_BUCKET = 50_000
MANY_ROWS, MANY_BYTES = 65_536, 16 << 20  # of a batch of short rows

# Bits of a filter of keys: blocks of 4 KB each, as many as these however many keys there are.
FILTER_BLOCKS, BLOCK_BITS = 1_024, 32_768
# Joins with texts are planned alike at every size, so a run on a part of the data tells what the whole needs.
SHUFFLE = "shuffle_merge"

ROW = "_row"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators rely on, set on the caller's session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


@contextmanager
def many_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside send batches of many short rows to Python, which are bounded by their bytes."""
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(MANY_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(MANY_BYTES)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def text_of(name: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def write_out(df: DataFrame, label: str) -> DataFrame:
    """The rows written to scratch, compressed well, and read back: lineage is cut in a folder all executors share."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows written to scratch with a unique ``_row``: ids stay the same however often a task is repeated."""
    return write_out(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def likely(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose ``key`` (long) may be one of ``keys``, or with ``left_anti`` those whose key cannot be.

    A bit stands for each key's hash, so no row is missing of those whose key is there, and a few others are taken along: a
    join has to follow, which then shuffles little more than it needs. The bits are broadcast; their size is fixed, and with
    more keys than it is made for only the number of other rows grows.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BLOCKS * BLOCK_BITS))
    bits = keys.select(slot.alias("_slot")).groupBy(F.floor(F.col("_slot") / BLOCK_BITS).alias("_block")).agg(
        F.bitmap_construct_agg(F.col("_slot") % BLOCK_BITS).alias("_bits"))
    at = slot % BLOCK_BITS
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    same = (F.floor(slot / BLOCK_BITS) == F.col("_block")) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return df.join(F.broadcast(bits), same, how)


def without_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``_row`` is not among ``rows``: only those that may be are shuffled to find out."""
    unsure = likely(df, rows, ROW).hint(SHUFFLE).join(rows.select(ROW), ROW, "left_anti")
    return likely(df, rows, ROW, "left_anti").unionByName(unsure)


def ranked(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of ``numbered`` with ``name``, their gapless place from 0 within ``key``.

    No task sees a whole key: rows are numbered within buckets of a key, and a bucket starts where the buckets before
    it end. The bucket table has one row per key and bucket.
    """
    buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(ROW), F.lit(buckets)))
    counts = placed.groupBy(key, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_bucket").orderBy(ROW)
    return (
        placed.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_bucket", "_inside", "_before")
    )

"""Landed documents: partitioned Parquet in which a document is replaced by its key."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.operators.gates import expect_keys
from gamegrain.operators.keys import key_set, only, without
from gamegrain.operators.versions import latest_by, quoted
from gamegrain.session import materialise
from gamegrain.sinks.tables import read_or_empty

# Keys per folder: documents of neighbouring ids share a folder, so folders stay few and files large.
BLOCK_KEYS = 10_000
# Numbers of wide blocks begin here, above those of all others. A load that touches so many blocks in the keys of one
# wide block is put there instead, into one folder.
WIDE, MANY_BLOCKS = 10**18, 10


def overwrite_partitions(df: DataFrame, path: str, *partition: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for; the others stay."""
    writer = df.hint("rebalance", *partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition).parquet(path)


def with_block(df: DataFrame, key: str, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """Adds the partition column ``block`` of a whole-number key."""
    return df.withColumn("block", F.floor(F.col(key) / block_keys).cast("bigint"))


def wide_block(key: str, wide_keys: int) -> Column:
    """Number of the wide block of a whole-number key."""
    return F.floor(F.col(key) / wide_keys).cast("bigint") + WIDE


def put_documents(
    df: DataFrame, path: str, key: str, version: str = "block", block_keys: int = BLOCK_KEYS, wide_keys: int | None = None
) -> None:
    """Store documents by key, replacing those that are there already.

    Of several documents with one key in ``df`` the one with the largest ``version`` stays, equal ones are decided by
    the other columns. A NULL key is refused, and nothing is stored then. No rows: nothing changes. Only the blocks of
    the new keys are written again; those between the first and the last of them are read (partition filter).

    With ``wide_keys`` a load of many neighbouring blocks goes to blocks of that many keys. A document that is stored already
    stays in its block, of whichever width, so none is stored twice.
    """
    blocked = with_block(df, key, block_keys)
    incoming = materialise(latest_by(blocked, [key], version), "incoming")
    expect_keys(incoming, key)
    if incoming.isEmpty():
        return
    stored = read_or_empty(df.sparkSession, path, blocked.schema)
    if wide_keys is not None:
        incoming = _placed(incoming, stored, key, wide_keys)
    kept = without(only(_near(stored, incoming, "block"), key_set(incoming, "block"), "block"), incoming, key)
    merged = incoming if kept.isEmpty() else materialise(incoming.unionByName(kept), "merged")
    overwrite_partitions(merged, path, "block")


def _near(stored: DataFrame, incoming: DataFrame, *blocks: str) -> DataFrame:
    """Stored documents in blocks between the first and the last of ``incoming``, those of wide blocks apart."""
    named = reduce(DataFrame.unionByName, [incoming.select(F.col(name).alias("block")) for name in blocks])
    spans = named.groupBy((F.col("block") >= WIDE).alias("wide")).agg(F.min("block").alias("low"), F.max("block").alias("high"))
    return stored.where(reduce(or_, [F.col("block").between(span["low"], span["high"]) for span in spans.collect()]))


def _placed(incoming: DataFrame, stored: DataFrame, key: str, wide_keys: int) -> DataFrame:
    """The documents with the block they go to. What is planned is one row for each wide block; documents move only if some
    are stored elsewhere."""
    wide = wide_block(key, wide_keys)
    keys = incoming.select(F.col(key), F.col("block"), wide.alias("wide"))
    many = keys.groupBy("wide").agg(F.count_distinct("block").alias("n")).where(F.col("n") >= MANY_BLOCKS).select("wide", F.lit(True).alias("many"))
    many = materialise(many, "wide-blocks")
    planned = F.when(F.col("many"), F.col("wide")).otherwise(F.col("block"))
    keys = keys.join(F.broadcast(many), "wide", "left")
    there = _near(stored, keys, "block", "wide").select(F.col(key), F.col("block").alias("there"))
    moved = there.join(keys.select(key, planned.alias("planned")), key).where(F.col("there") != F.col("planned"))
    moved = materialise(moved.select(key, "there"), "stored-elsewhere")
    placed = incoming.withColumn("wide", wide).join(F.broadcast(many), "wide", "left").withColumn("block", planned).drop("wide", "many")
    if moved.isEmpty():
        return placed
    placed = placed.join(moved, key, "left").withColumn("block", F.coalesce("there", "block")).drop("there")
    return materialise(placed.select(*map(quoted, incoming.columns)), "placed")

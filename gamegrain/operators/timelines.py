"""Ordered lists per key.

Inside a document the list is sorted in place (``sorted_items``), which needs no shuffle. Rows of a table that have
to be brought together go through ``ordered_lists``, which never builds a list longer than asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamegrain.session import materialise


def sorted_items(outer: Column, inner: str, make) -> Column:
    """Two-level array → one sorted array of structs ``make(outer_item, inner_item)``, in natural order."""
    flat = F.flatten(
        F.transform(
            F.coalesce(outer, F.array()),
            lambda item: F.coalesce(F.transform(item[inner], lambda leaf: make(item, leaf)), F.array()),
        )
    )
    return F.sort_array(flat)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``position``, their 0-based rank within the key, for keys of any size.

    A window over the key would put a hot key into one task. Instead the rows are range-partitioned by key *and*
    order, so a hot key spreads over many partitions; the count of a key in the partitions before is added to the
    place within the partition. The sorted rows are written once, so that both uses see the same partitioning.
    A written row number breaks ties, so that a large group of equal rows spreads out as well.
    """
    tied = materialise(df.withColumn("_tie", F.monotonically_increasing_id()), "tied")
    ranged = (
        tied.repartitionByRange(*keys, *order, "_tie")
        .sortWithinPartitions(*keys, *order, "_tie")
        .drop("_tie")
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_slot"))
    )
    placed = materialise(ranged, "positions")
    # One row per key and partition it touches: keys plus partitions, whatever the size of the keys.
    pieces = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *keys, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # Null-safe: rows without a key are a key of their own.
    begun = starts.toDF(*[f"_of_{name}" for name in starts.columns[:-1]], "_before")
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in (*keys, "_part")]
    return (
        placed.join(begun, same)
        .withColumn("position", F.col("_slot") - F.col("_of__first") + F.col("_before"))
        .drop("_part", "_slot", *begun.columns)
    )


def ordered_lists(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str] = (), max_items: int = 10_000
) -> DataFrame:
    """Rows → (keys, ``segment``, ``items``): structs of ``order`` and ``fields`` in order, at most ``max_items`` each.

    Segment ``floor(position / max_items)`` for every key, of any size; reading the segments in turn gives the whole
    list. ``order`` has to name all columns that make rows differ if equal rows are not interchangeable. Rows whose key
    is NULL are one list.
    """
    wanted = list(dict.fromkeys([*order, *fields]))
    rows = df.select(*keys, *[name for name in wanted if name not in keys])
    items = F.sort_array(F.collect_list(F.struct(*wanted))).alias("items")
    placed = positions(rows, keys, order)
    segment = F.floor(F.col("position") / max_items).cast("bigint").alias("segment")
    return placed.groupBy(*keys, segment).agg(items)

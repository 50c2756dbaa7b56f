"""Joins to dimensions and to literal lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join to a dimension; facts without a match drop.

    No hint: Spark's byte threshold and adaptive execution decide from measured sizes whether the dimension is sent
    to every executor, and split the partitions of hot keys otherwise.
    """
    return facts.join(dimension, list(on), "inner")


def join_lookup(facts: DataFrame, lookup: DataFrame, *on: str) -> DataFrame:
    """Inner join to a relation made of literals, whose size the caller's code fixes."""
    return facts.join(F.broadcast(lookup), list(on), "inner")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables has, with the side that lacks them."""
    marked_left = left.select(key).distinct().withColumn("in_left", F.lit(True))
    marked_right = right.select(key).distinct().withColumn("in_right", F.lit(True))
    both = marked_left.join(marked_right, key, "full_outer")
    missing = F.when(F.col("in_left").isNull(), F.lit("left")).when(F.col("in_right").isNull(), F.lit("right"))
    return both.select(key, missing.alias("missing_in")).where("missing_in IS NOT NULL")

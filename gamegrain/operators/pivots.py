"""Attribute/value rows to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def eav_pivot(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    value: str,
    categories: Sequence[str],
    first_by: Sequence[str] = (),
) -> DataFrame:
    """One column per listed category; a category without rows is a NULL column.

    Duplicates: the first value in ``first_by`` order, or the largest one without it. Conditional aggregates need
    one shuffle and combine before it, and the schema does not depend on the data.
    """

    def pick(name: str) -> Column:
        hit = F.col(category) == name
        if first_by:
            return F.min_by(F.col(value), F.when(hit, F.struct(*first_by)))
        return F.max(F.when(hit, F.col(value)))

    return df.groupBy(*keys).agg(*[pick(name).alias(name) for name in categories])


def pivot_map(
    df: DataFrame, keys: Sequence[str], category: str, value: str, first_by: Sequence[str], name: str = "attributes"
) -> DataFrame:
    """One map per key from category to value: the categories are those that the data hold, the schema is fixed.

    Duplicates: the first value in ``first_by`` order. A NULL category is none. Values are chosen before the map is
    built, so a map has one entry for each category of its key, sorted by category; no pass looks for categories first.
    """
    first = F.min_by(F.struct(F.col(value).alias("value")), F.struct(*first_by)).alias("first")
    cells = df.where(F.col(category).isNotNull()).groupBy(*keys, F.col(category).alias("category")).agg(first)
    entries = F.array_sort(F.collect_list(F.struct("category", F.col("first.value").alias("value"))))
    return cells.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))


def pivot_join_back(base: DataFrame, attributes: DataFrame, keys: Sequence[str], **pivot) -> DataFrame:
    """Base rows with the pivoted attributes of their key; rows without any attribute drop."""
    return base.join(eav_pivot(attributes, keys, **pivot), list(keys), "inner")

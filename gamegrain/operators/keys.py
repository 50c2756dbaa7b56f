"""Key sets as one-column frames: they never pass through the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, *keys: str, where: Column | str | None = None) -> DataFrame:
    """Distinct keys of a table, the predicate applied at the scan; NULL keys are no keys."""
    rows = df if where is None else df.where(where)
    return rows.select(*keys).dropna().distinct()


def any_of(*sets: DataFrame) -> DataFrame:
    """Union of key sets, each key once."""
    return reduce(DataFrame.unionByName, sets).distinct()


def only(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows whose key is in the set. The set is made distinct before the shuffle: a hot key there is one row."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def without(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """Rows whose key is not in the set; rows with a NULL key drop, whether or not the set is empty."""
    return df.dropna(subset=list(on)).join(keys.select(*on).distinct(), list(on), "left_anti")


def listed_ids(df: DataFrame, *arrays: Column | str, name: str = "id") -> DataFrame:
    """Distinct elements of several id lists per row."""
    lists = [F.coalesce(F.col(item) if isinstance(item, str) else item, F.array()) for item in arrays]
    return df.select(F.explode(F.concat(*lists)).alias(name)).dropna().distinct()

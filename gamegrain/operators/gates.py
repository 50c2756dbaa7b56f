"""Counts and the checks that stop a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A load must not go on."""


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Row count as a one-row frame."""
    return df.agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, *columns: str, name: str = "keys") -> DataFrame:
    """Exact count of distinct values as a one-row frame: grouped first, so no task sees all values."""
    return df.select(*columns).dropna().distinct().agg(F.count("*").alias(name))


def expect_distinct(df: DataFrame, column: str, expected: int) -> None:
    """Raise unless the table holds exactly ``expected`` distinct values."""
    found = distinct_count(df, column).first()[0]
    if found != expected:
        raise GateError(f"{found} distinct {column} instead of {expected}")


def expect_keys(df: DataFrame, key: str) -> None:
    """Raise if a row has no key."""
    if not df.where(F.col(key).isNull()).isEmpty():
        raise GateError(f"rows without {key}")


def expect_rows(df: DataFrame, what: str) -> None:
    """Raise if there is no row; looks at one row only."""
    if df.isEmpty():
        raise GateError(f"no rows in {what}")


def with_content(documents: DataFrame, *arrays: str) -> DataFrame:
    """Documents in which at least one of the arrays has an element."""
    sizes = [F.coalesce(F.size(F.col(f"`{name}`")), F.lit(0)) for name in arrays]
    return documents.where(F.greatest(*sizes, F.lit(0)) > 0)


def summary(**tables: DataFrame) -> DataFrame:
    """One row with the row count of each table (the report of a run)."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, counts)
    return stacked.agg(*[F.max(F.when(F.col("table") == name, F.col("rows"))).alias(name) for name in tables])

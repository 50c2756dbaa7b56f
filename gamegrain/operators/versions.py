"""Versioned rows: many versions of a key are stored, the newest one counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key; equal versions are decided by ``ties`` and then by the other columns.

    An arg-max aggregate: each task keeps one row per key before the shuffle, so a hot key costs no more than any.
    """
    rest = [name for name in df.columns if name not in keys]
    order = [version, *ties, *[name for name in rest if name != version and name not in ties]]
    newest = F.max(F.struct(*map(quoted, order)))
    return df.groupBy(*map(quoted, keys)).agg(newest.alias("newest")).select(
        *[quoted(name) if name in keys else F.col("newest").getField(name).alias(name) for name in df.columns]
    )


def quoted(name: str) -> Column:
    """The column of that name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")

"""Home and away: unpivoting the two sides of a game, and letting each side see the other's figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("home", "away")


def side_rows(
    games: DataFrame, shared: Sequence[Column | str], sides: Mapping[str, Mapping[str, Column]], label: str = "team_type"
) -> DataFrame:
    """One row per game and side.

    ``sides`` maps each label to the columns that side contributes under common names. The source is scanned once
    and nothing is shuffled: the sides are structs of one small array that is exploded.
    """
    entries = [
        F.struct(F.lit(name).alias(label), *[column.alias(alias) for alias, column in columns.items()])
        for name, columns in sides.items()
    ]
    return games.select(*shared, F.inline(F.array(*entries)))


def side_totals(
    rows: DataFrame, game: str, side: str, metrics: Mapping[str, Column], sides: Sequence[str] = SIDES
) -> DataFrame:
    """Sums per game, one column per metric and side (``<side>_<metric>``), plus ``<side>_rows``."""
    return rows.groupBy(game).agg(
        *[F.count(F.when(F.col(side) == name, 1)).alias(f"{name}_rows") for name in sides],
        *[
            F.sum(F.when(F.col(side) == name, metric)).alias(f"{name}_{alias}")
            for name in sides
            for alias, metric in metrics.items()
        ],
    )


def facing_rows(
    totals: DataFrame, game: str, metrics: Sequence[str], sides: Sequence[str] = SIDES, label: str = "team_type"
) -> DataFrame:
    """One row per side with its own figures and the other side's as ``opp_<metric>``; games with one side drop."""
    first, second = sides

    def columns(own: str, other: str) -> dict[str, Column]:
        return {m: F.col(f"{own}_{m}") for m in metrics} | {f"opp_{m}": F.col(f"{other}_{m}") for m in metrics}

    complete = totals.where((F.col(f"{first}_rows") > 0) & (F.col(f"{second}_rows") > 0))
    return side_rows(complete, [game], {first: columns(first, second), second: columns(second, first)}, label)


def with_opponent(
    stats: DataFrame, game: str, side: str, fields: Sequence[str], sides: Sequence[str] = SIDES
) -> DataFrame:
    """Opponent self-join for rows that are unique per (game, side): each row gets ``opp_<field>`` of the other side.

    Rows without an opponent drop. The right side carries only the fields asked for.
    """
    first, second = sides
    other = stats.where(F.col(side).isin(first, second)).select(
        game,
        F.when(F.col(side) == first, F.lit(second)).otherwise(F.lit(first)).alias(side),
        *[F.col(name).alias(f"opp_{name}") for name in fields],
    )
    return stats.join(other, [game, side], "inner")

"""Weekly schedule documents → ``schedule``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import utc_second
from gamegrain.functions.nested import picks
from gamegrain.functions.text import fold_ascii, full_name
from gamegrain.operators.sides import SIDES
from gamegrain.sources.lookups import FINAL_STATE, VALID_GAME_TYPES
from gamegrain.streaming.increments import open_rows


def _team(side: str) -> list[Column]:
    team = f"game.{side}Team"
    name = full_name(f"{team}.placeName.default", f"{team}.commonName.default")
    return [
        F.col(f"{team}.id").alias(f"{side}_team_id"),
        F.col(f"{team}.abbrev").alias(f"{side}_team_abbrev"),
        fold_ascii(name).alias(f"{side}_team_name"),
    ]


def schedule(documents: DataFrame, loaded: DataFrame, game_types: Sequence[int] = VALID_GAME_TYPES) -> DataFrame:
    """One row per game of the wanted types that is not final in the loaded table yet."""
    days = documents.select(F.explode("gameWeek").alias("day"), "updated_at")
    games = days.select(F.explode("day.games").alias("game"), "updated_at")
    wanted = games.where(F.col("game.gameType").isin(*game_types))
    rows = wanted.select(
        *picks(F.col("game"), [("id", "game_id"), "season"]),
        utc_second(F.col("game.startTimeUTC")).alias("start_time"),
        *picks(F.col("game"), [("gameType", "game_type"), ("venue.default", "venue")]),
        *[column for side in SIDES for column in _team(side)],
        *picks(F.col("game"), [("gameState", "game_state"), ("gameScheduleState", "game_schedule_state")]),
        utc_second(F.col("updated_at")).alias("updated_at"),
    )
    return open_rows(rows, loaded, "game_id", F.col("game_state") == FINAL_STATE)

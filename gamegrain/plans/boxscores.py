"""Boxscore documents → ``skater_game_stats`` and ``goalie_game_stats``. Neither shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import clock_seconds, utc_second
from gamegrain.functions.nested import Pick, concat_safe, picks
from gamegrain.functions.text import fold_ascii, full_name
from gamegrain.operators.sides import SIDES, side_rows

# Fields of a player line and their names in the table.
_WHO: list[Pick] = [
    ("playerId", "player_id"), ("name.default", "player_name"), "position", ("sweaterNumber", "sweater_number"),
]
SKATER_FIELDS: list[Pick] = [
    *_WHO, "goals", "assists", "points", ("plusMinus", "plus_minus"), ("pim", "penalty_minutes"),
    ("powerPlayGoals", "power_play_goals"), ("sog", "shots"), "hits", ("blockedShots", "blocked_shots"),
    ("faceoffWinningPctg", "faceoff_winning_pctg"), "giveaways", "takeaways", "shifts", ("toi", "time_on_ice"),
]
GOALIE_FIELDS: list[Pick] = [
    *_WHO, "starter", "decision", "saves", ("shotsAgainst", "shots_against"), ("savePctg", "save_pctg"),
    ("goalsAgainst", "goals_against"), ("pim", "penalty_minutes"), ("toi", "time_on_ice"),
]
SKATER_GROUPS, GOALIE_GROUPS = ("forwards", "defense"), ("goalies",)

_GAME = ["game_id", "season", "start_time"]
_TEAM = ["team_type", "team_id", "team_abbrev", "team_name"]


def side_lines(documents: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per game and side with ``lines``, the player lines of the asked groups in one array.

    Only those groups are read; a missing group does not hide the others.
    """
    sides = {
        side: {
            "team_id": F.col(f"`{side}Team.id`"),
            "team_abbrev": F.col(f"`{side}Team.abbrev`"),
            "team_name": fold_ascii(
                full_name(f"`{side}Team.placeName.default`", f"`{side}Team.commonName.default`")
            ),
            "lines": concat_safe(*[F.col(f"`playerByGameStats.{side}Team.{group}`") for group in groups]),
        }
        for side in SIDES
    }
    shared = [
        F.col("id").alias("game_id"),
        "season",
        utc_second(F.col("startTimeUTC")).alias("start_time"),
        utc_second(F.col("updated_at")).alias("updated_at"),
    ]
    return side_rows(documents, shared, sides)


def player_lines(documents: DataFrame, groups: Sequence[str], fields: Sequence[Pick]) -> DataFrame:
    """One row per player line: game, team, the picked fields, and the time on ice in seconds."""
    lines = side_lines(documents, groups).select(*_GAME, *_TEAM, F.explode("lines").alias("line"), "updated_at")
    rows = lines.select(*_GAME, *_TEAM, *picks(F.col("line"), fields), "updated_at")
    names = [name for name in rows.columns if name != "updated_at"]
    return rows.withColumn("player_name", fold_ascii(F.col("player_name"))).select(
        *names, clock_seconds(F.col("time_on_ice")).alias("time_on_ice_seconds"), "updated_at"
    )


def skater_game_stats(documents: DataFrame) -> DataFrame:
    return player_lines(documents, SKATER_GROUPS, SKATER_FIELDS)


def goalie_game_stats(documents: DataFrame) -> DataFrame:
    return player_lines(documents, GOALIE_GROUPS, GOALIE_FIELDS)

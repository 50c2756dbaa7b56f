"""Inline relations and season settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The season, the game types that count, and the teams by division and conference.
SEASON = 20252026
SEASON_FIRST_DAY, SEASON_LAST_DAY = "2025-10-07", "2026-04-17"
VALID_GAME_TYPES = (2,)
FINAL_STATE = "OFF"
DIVISIONS = {
    "Atlantic": ("BOS", "BUF", "DET", "FLA", "MTL", "OTT", "TBL", "TOR"),
    "Central": ("CHI", "COL", "DAL", "MIN", "NSH", "STL", "UTA", "WPG"),
    "Metropolitan": ("CAR", "CBJ", "NJD", "NYI", "NYR", "PHI", "PIT", "WSH"),
    "Pacific": ("ANA", "CGY", "EDM", "LAK", "SEA", "SJS", "VAN", "VGK"),
}
CONFERENCE_DIVISIONS = {"Eastern": ("Atlantic", "Metropolitan"), "Western": ("Central", "Pacific")}
CONFERENCES = {
    name: tuple(team for division in divisions for team in DIVISIONS[division])
    for name, divisions in CONFERENCE_DIVISIONS.items()
}
TEAMS = tuple(sorted(team for teams in DIVISIONS.values() for team in teams))


def membership(spark: SparkSession, groups: dict, group: str, member: str, member_type: str = "string") -> DataFrame:
    """``{group: members}`` → one row per (group, member), both columns not null."""
    rows = [(name, item) for name, items in groups.items() for item in items]
    schema = f"`{group}` string not null, `{member}` {member_type} not null"
    return spark.createDataFrame(rows, schema)


def conferences(spark: SparkSession) -> DataFrame:
    return membership(spark, CONFERENCES, "conference", "team_abbrev")


def divisions(spark: SparkSession) -> DataFrame:
    return membership(spark, DIVISIONS, "division", "team_abbrev")

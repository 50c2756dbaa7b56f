"""Team documents → ``team_meta`` and ``team_rosters``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import utc_second
from gamegrain.functions.nested import concat_safe, picks
from gamegrain.functions.text import fold_ascii, full_name, path_key
from gamegrain.operators.joins import join_dimension, join_lookup
from gamegrain.sources.readers import FILE_PATH


def team_meta(documents: DataFrame, conferences: DataFrame, divisions: DataFrame) -> DataFrame:
    """One row per team; teams without a conference or a division drop. The lookups are literal relations."""
    teams = documents.select(F.explode("teams").alias("team"), "updated_at").select(
        *picks(F.col("team"), [("teamId", "team_id"), ("tricode", "team_abbrev"), ("name.default", "team_name")]),
        utc_second(F.col("updated_at")).alias("updated_at"),
    )
    labelled = join_lookup(join_lookup(teams, conferences, "team_abbrev"), divisions, "team_abbrev")
    return labelled.select(
        "team_id", "team_abbrev", fold_ascii(F.col("team_name")).alias("team_name"), "conference", "division",
        "updated_at",
    )


def rosters_with_team(documents: DataFrame) -> DataFrame:
    """Roster documents with the team code that only their file name carries."""
    return documents.withColumn("team_abbrev", path_key(F.col(FILE_PATH)))


def team_rosters(documents: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per player of the current rosters. ``documents`` have a ``team_abbrev``; ``teams`` is ``team_meta``
    with one row per team."""
    lists = documents.select(
        "team_abbrev",
        concat_safe(F.col("forwards"), F.col("defensemen"), F.col("goalies")).alias("players"),
        utc_second(F.col("updated_at")).alias("updated_at"),
    )
    known = join_dimension(lists, teams.select("team_id", "team_abbrev", "team_name"), ["team_abbrev"])
    players = known.select("team_id", "team_abbrev", "team_name", F.explode("players").alias("player"), "updated_at")
    name = full_name("player.firstName.default", "player.lastName.default")
    return players.select(
        "team_id",
        "team_abbrev",
        "team_name",
        F.col("player.id").alias("player_id"),
        fold_ascii(name).alias("player_full_name"),
        F.col("player.positionCode").alias("position"),
        F.col("player.sweaterNumber").alias("sweater_number"),
        "updated_at",
    )

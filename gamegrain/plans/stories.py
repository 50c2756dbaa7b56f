"""Game story documents → ``game_results`` and ``team_game_stats``.

Everything a game needs is in its one document, so goals are ordered, attributes pivoted and sides compared within
the row: no flow here shuffles, and one large document never meets another in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import game_clock, game_seconds, utc_second
from gamegrain.functions.nested import cell, ordered_by, parallel_arrays
from gamegrain.functions.points import rate_or_zero, result_points
from gamegrain.functions.text import fold_ascii, full_name, split_ratio, whole_number
from gamegrain.operators.sides import SIDES, side_rows
from gamegrain.operators.timelines import sorted_items
from gamegrain.sources.feeds import SCORING

# The fields of a goal in table order, and the statistics with their category in the document.
GOAL_FIELDS = ("goal_time", "home_score", "away_score", "strength", "scorer_player_id", "assists_player_ids")
WHOLE_STATS = {
    "shots_on_goal": "sog", "blocked_shots": "blockedShots", "giveaways": "giveaways", "takeaways": "takeaways",
    "hits": "hits", "penalty_minutes": "pim",
}
SHARE_STATS = {"faceoff_winning_pctg": "faceoffWinningPctg", "power_play_pctg": "powerPlayPctg"}
POWER_PLAY = "powerPlay"


def _other(side: str) -> str:
    return SIDES[1 - SIDES.index(side)]


def story_games(documents: DataFrame) -> DataFrame:
    """One row per game: plain names, parsed goals, points of both sides."""

    def team(side: str) -> list[Column]:
        name = full_name(f"`{side}Team.placeName.default`", f"`{side}Team.name.default`")
        own, other = (F.col(f"`{who}Team.score`") for who in (side, _other(side)))
        return [
            F.col(f"`{side}Team.id`").alias(f"{side}_team_id"),
            F.col(f"`{side}Team.abbrev`").alias(f"{side}_team_abbrev"),
            name.alias(f"{side}_team_name"),
            own.alias(f"{side}_team_score"),
            result_points(own, other, F.col("`periodDescriptor.periodType`")).alias(f"{side}_team_points"),
        ]

    return documents.select(
        F.col("id").alias("game_id"),
        "season",
        F.col("gameType").alias("game_type"),
        utc_second(F.col("startTimeUTC")).alias("start_time"),
        F.col("gameState").alias("game_state"),
        F.col("gameScheduleState").alias("game_schedule_state"),
        *[column for side in SIDES for column in team(side)],
        F.from_json(F.col("`summary.scoring`"), SCORING).alias("scoring"),
        F.col("`summary.threeStars`").alias("three_stars"),
        F.col("`summary.teamGameStats`").alias("team_game_stats"),
        F.col("`periodDescriptor.periodType`").alias("period_type"),
        utc_second(F.col("updated_at")).alias("updated_at"),
    )


def goal_list(scoring: Column) -> Column:
    """Periods with goals → goals of the game by clock, equal clocks by the score after the goal."""

    def goal(period: Column, item: Column) -> Column:
        number = period["periodDescriptor"]["number"]
        return F.struct(
            game_seconds(number, item["timeInPeriod"]).alias("second"),
            game_clock(number, item["timeInPeriod"]).alias("goal_time"),
            item["homeScore"].alias("home_score"),
            item["awayScore"].alias("away_score"),
            item["strength"].alias("strength"),
            item["playerId"].alias("scorer_player_id"),
            F.coalesce(item["assists"]["playerId"], F.array()).alias("assists_player_ids"),
        )

    return sorted_items(scoring, "goals", goal)


def game_results(games: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per game with its goals as parallel arrays and its three stars.

    Games without any goal drop unless ``keep_empty`` (they then have empty arrays).
    """
    stars = ordered_by(F.col("three_stars"), "star").getField("playerId")
    listed = games.select(
        "game_id", "season", "start_time", "period_type", "home_team_score", "away_team_score",
        *[
            column
            for side in SIDES
            for column in (
                F.col(f"{side}_team_id"),
                F.col(f"{side}_team_abbrev"),
                fold_ascii(F.col(f"{side}_team_name")).alias(f"{side}_team_name"),
            )
        ],
        stars.alias("three_stars_player_ids"),
        goal_list(F.col("scoring")).alias("goals"),
        "updated_at",
    )
    kept = listed if keep_empty else listed.where(F.size("goals") > 0)
    names = [name for name in kept.columns if name not in ("goals", "updated_at")]
    return kept.select(*names, *parallel_arrays("goals", GOAL_FIELDS, "goals_"), "updated_at")


def side_stats(games: DataFrame) -> DataFrame:
    """One row per game and side: its statistics as text, and the other side's as far as they are compared."""
    stats = F.col("team_game_stats")

    def text(side: str, category: str) -> Column:
        return cell(stats, F.lit(category), "category", f"{side}Value")

    def columns(side: str) -> dict[str, Column]:
        other = _other(side)
        return {
            **{name: F.col(f"{side}_{name}") for name in ("team_id", "team_abbrev")},
            "team_name": fold_ascii(F.col(f"{side}_team_name")),
            "score": F.col(f"{side}_team_score"),
            "points": F.col(f"{side}_team_points"),
            **{name: text(side, category) for name, category in (WHOLE_STATS | SHARE_STATS).items()},
            "power_play": text(side, POWER_PLAY),
            "opp_power_play": text(other, POWER_PLAY),
            "opp_shots_on_goal": text(other, WHOLE_STATS["shots_on_goal"]),
        }

    shared = ["game_id", "season", "start_time", "period_type", "updated_at"]
    counted = games.where(F.size("team_game_stats") > 0)
    return side_rows(counted, shared, {side: columns(side) for side in SIDES})


def team_game_stats(games: DataFrame) -> DataFrame:
    """Two rows per game: each team's figures, and what it allowed the other. Games without statistics drop."""
    sides = side_stats(games)
    whole = {name: whole_number(F.col(name)) for name in [*WHOLE_STATS, "opp_shots_on_goal"]}
    share = {name: F.col(name).try_cast("float") for name in SHARE_STATS}
    return sides.withColumns(whole | share).select(
        "game_id", "season", "start_time", "team_type", "team_id", "team_abbrev", "team_name", "score", "points",
        "period_type", "shots_on_goal",
        F.col("opp_shots_on_goal").alias("shots_against"),
        "blocked_shots", "faceoff_winning_pctg", "giveaways", "takeaways", "hits", "penalty_minutes",
        split_ratio(F.col("power_play"), 0).alias("power_play_goals"),
        split_ratio(F.col("power_play"), 1).alias("times_power_play"),
        "power_play_pctg",
        split_ratio(F.col("opp_power_play"), 1).alias("times_shorthand"),
        # A later column may name an alias of the same select.
        (F.col("times_shorthand") - split_ratio(F.col("opp_power_play"), 0)).alias("penalty_kill"),
        rate_or_zero(F.col("penalty_kill"), F.col("times_shorthand")).alias("penalty_kill_pctg"),
        "updated_at",
    )

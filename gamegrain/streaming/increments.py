"""What is new, what is still open, what is due."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import age_days
from gamegrain.operators.keys import key_set, without
from gamegrain.sources.lookups import FINAL_STATE, VALID_GAME_TYPES


def new_keys(stored: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    """Keys in storage and not in one target. Each target has its own list, so a half-loaded key is completed."""
    return without(key_set(stored, *keys), loaded, *keys)


def open_rows(rows: DataFrame, loaded: DataFrame, key: str, closed: Column | str) -> DataFrame:
    """Rows whose key has no closed row in the table: closed ones are frozen, open ones are loaded again."""
    return without(rows, key_set(loaded, key, where=closed), key)


def open_periods(periods: DataFrame, stored: DataFrame, today: date) -> DataFrame:
    """Periods to fetch: all but those that are stored and ended before yesterday."""
    ended = F.date_sub(F.lit(today), 1) > F.col("period_end")
    closed = periods.where(ended).join(stored.select("period_start").distinct(), "period_start", "left_semi")
    return periods.join(closed.select("period_start"), "period_start", "left_anti")


def played_days(weeks: DataFrame) -> DataFrame:
    """Weeks with the days that have games; weeks without such a day drop. Filters inside the document."""
    with_games = F.filter("gameWeek", lambda day: F.coalesce(day["numberOfGames"], F.lit(0)) != 0)
    return weeks.withColumn("gameWeek", with_games).where(F.size("gameWeek") > 0)


def finished_games(
    weeks: DataFrame, game_types: Sequence[int] = VALID_GAME_TYPES, final: str = FINAL_STATE
) -> DataFrame:
    """Distinct ids of finished games that count."""
    games = weeks.select(F.explode("gameWeek").alias("day")).select(F.explode("day.games").alias("game"))
    finished = (F.col("game.gameState") == final) & F.col("game.gameType").isin(*game_types)
    return games.where(finished).select(F.col("game.id").alias("game_id")).dropna().distinct()


def reload_due(newest: DataFrame, table: DataFrame, now: datetime, max_age_days: int = 1) -> bool:
    """Reference data is loaded once: due unless the table has rows and the newest file is old already.

    ``newest`` is the one-row result of ``newest_file``; without any file nothing is due.
    """
    age = newest.select(age_days(F.col("modified_at"), F.lit(now)).alias("age")).first()["age"]
    return age is not None and (age < max_age_days or table.isEmpty())


def feed_completeness(documents: DataFrame, key: str, feed: str, feeds: Sequence[str]) -> DataFrame:
    """Per key: which feeds are stored (``has_<feed>``) and whether all are (``complete``)."""
    present = documents.groupBy(key).agg(
        *[F.coalesce(F.max(F.col(feed) == name), F.lit(False)).alias(f"has_{name}") for name in feeds]
    )
    return present.withColumn("complete", F.expr(" AND ".join(f"`has_{name}`" for name in feeds)))

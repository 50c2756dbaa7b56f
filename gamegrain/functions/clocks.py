"""Clock texts, time stamps and dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Length of a period, and the clock of a goal in the shoot-out (always after 60 + 5 minutes).
PERIOD_MINUTES = 20
SHOOTOUT_PERIOD = 5
SHOOTOUT_CLOCK = "65:00"


def _minutes_and_seconds(clock: Column) -> tuple[Column, Column]:
    parts = F.split(clock, ":")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def clock_seconds(clock: Column) -> Column:
    """``"mm:ss"`` → seconds; NULL for anything else."""
    minutes, seconds = _minutes_and_seconds(clock)
    return minutes * 60 + seconds


def game_seconds(period: Column, clock: Column) -> Column:
    """Seconds from the start of the game."""
    shootout = int(SHOOTOUT_CLOCK[:2]) * 60
    return F.when(period == SHOOTOUT_PERIOD, F.lit(shootout)).otherwise(
        clock_seconds(clock) + (period.cast("int") - 1) * (PERIOD_MINUTES * 60)
    )


def game_clock(period: Column, clock: Column) -> Column:
    """Clock within a period → clock of the game: period 1 as it is, a shoot-out goal at ``65:00``."""
    minutes = _minutes_and_seconds(clock)[0] + (period.cast("int") - 1) * PERIOD_MINUTES
    later = F.concat(minutes.cast("string"), F.lit(":"), F.get(F.split(clock, ":"), F.lit(1)))
    return F.when(period == 1, clock).when(period == SHOOTOUT_PERIOD, F.lit(SHOOTOUT_CLOCK)).otherwise(later)


def utc_second(text: Column) -> Column:
    """ISO-8601 text → timestamp cut to the second; needs a session in UTC for texts without an offset."""
    return F.date_trunc("second", F.try_to_timestamp(text))


def to_day(text: Column) -> Column:
    """Date text → date, NULL where it is none."""
    return text.try_cast("date")


def age_days(since: Column, now: Column) -> Column:
    """Whole days between two time stamps."""
    return F.timestamp_diff("DAY", since, now)


def periods(spark: SparkSession, first: date | str, last: date | str, days: int = 7) -> DataFrame:
    """One row per period of ``days`` days between two dates: ``period_start``, ``period_end``."""
    starts = F.sequence(
        F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"), F.make_dt_interval(F.lit(days))
    )
    return (
        spark.range(1)
        .select(F.explode(starts).alias("period_start"))
        .select("period_start", F.date_add("period_start", days - 1).alias("period_end"))
    )

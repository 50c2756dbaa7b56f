"""Derived figures of a game."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The league's points, and the period type of a game decided in regulation time.
WIN_POINTS, OVERTIME_LOSS_POINTS, LOSS_POINTS = 2, 1, 0
REGULATION = "REG"


def result_points(own: Column, other: Column, period_type: Column) -> Column:
    """Win 2, loss after regulation time 1, else 0; an unknown period type counts as regulation."""
    return (
        F.when(own > other, F.lit(WIN_POINTS))
        .when(period_type != REGULATION, F.lit(OVERTIME_LOSS_POINTS))
        .otherwise(F.lit(LOSS_POINTS))
    )


def rate_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole`` as a 4-byte float; 0 where there was nothing to take a part of."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole).cast("float")

"""Counts and gates that are measured in the pass that writes the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gamegrain.operators.gates import GateError

ROWS = "rows"
SMALL_KEYS = 32_768  # values that one bitmap tells apart


@dataclass(frozen=True)
class Gate:
    """The column has exactly ``distinct`` different values, whole numbers from 1 to 32,768; NULLs do not count.

    One bitmap holds them, so the measure is exact and four kilobytes long, whatever comes.
    """

    column: str
    distinct: int

    def measures(self, n: int):
        value = F.col(self.column).cast("bigint")
        inside = value.between(1, SMALL_KEYS)
        bit = F.when(inside, F.bitmap_bit_position(value))
        return [F.bitmap_construct_agg(F.coalesce(bit, F.lit(None).cast("bigint"))).alias(f"bits_{n}"),
                F.count_if(~inside).alias(f"outside_{n}")]


def observed(df: DataFrame, *gates: Gate) -> tuple[Observation, DataFrame]:
    """The frame with its counts attached; they are there when an action over it has ended."""
    measured = Observation()
    counts = [F.count(F.lit(1)).alias(ROWS), *(m for n, gate in enumerate(gates) for m in gate.measures(n))]
    return measured, df.observe(measured, *counts)


def check(measured: Observation, what: str, *gates: Gate) -> int:
    """Raise unless there are rows and all gates hold; gives the number of rows."""
    found = measured.get
    if not found[ROWS]:
        raise GateError(f"no rows in {what}")
    for n, gate in enumerate(gates):
        if found[f"outside_{n}"]:
            raise GateError(f"{found[f'outside_{n}']} values of {gate.column} outside 1 to {SMALL_KEYS} in {what}")
        distinct = sum(octet.bit_count() for octet in found[f"bits_{n}"])
        if distinct != gate.distinct:
            raise GateError(f"{distinct} distinct {gate.column} instead of {gate.distinct} in {what}")
    return found[ROWS]


def counted_write(df: DataFrame, path: str, *gates: Gate) -> int:
    """Writes Parquet and gives the number of rows that were written, gates checked afterwards."""
    measured, watched = observed(df, *gates)
    watched.write.parquet(path)
    return check(measured, path, *gates)

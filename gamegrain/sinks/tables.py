"""Tables on files: append-once facts, versioned upserts, staged snapshots.

A table is a folder with one sub-folder per write and a small ``published`` table that names the valid ones. An append
joins the current generation, a replacement begins a new one; readers take all snapshots of the newest generation. A
snapshot that was not published does not exist for readers, so a lost executor, a failed job or a failed gate leaves
the table as it was, and nothing ever overwrites files that a running query reads. One writer at a time per table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamegrain.operators.keys import key_set, without
from gamegrain.operators.observed import Gate, check, observed
from gamegrain.operators.versions import latest_by
from gamegrain.sinks.contracts import TableSpec, conform

_PUBLISHED = "snapshot string, generation string, published_at timestamp"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet at ``path``, or no rows if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Table:
    """One table below ``root``; ``spread_by`` names the columns whose equal values are stored together."""

    spark: SparkSession
    root: str
    spec: TableSpec
    spread_by: tuple[str, ...] = ()

    def _generation(self) -> tuple[str | None, list[str]]:
        """The newest generation and its snapshots: one per append since the last replacement."""
        published = read_or_empty(self.spark, f"{self.root}/published", _PUBLISHED)
        row = published.groupBy("generation").agg(F.collect_set("snapshot").alias("parts")).agg(
            F.max(F.struct("generation", "parts")).alias("newest")
        ).first()["newest"]
        return (None, []) if row is None else (row["generation"], row["parts"])

    def _path(self, snapshot: str) -> str:
        return f"{self.root}/snapshots/{snapshot}"

    def _publish(self, snapshot: str, generation: str) -> None:
        row = self.spark.createDataFrame([(snapshot, generation, datetime.now(timezone.utc))], _PUBLISHED)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def _write(self, df: DataFrame, snapshot: str, mode: str = "append") -> None:
        """Rows in contract types, sorted by key within each file.

        The rebalance hint brings equal keys together but lets adaptive execution split what is too big for one
        task; without ``spread_by`` nothing is shuffled.
        """
        rows = conform(df, self.spec)
        if self.spread_by:
            rows = rows.hint("rebalance", *self.spread_by)
        rows.sortWithinPartitions(*self.spec.keys).write.mode(mode).parquet(self._path(snapshot))

    @staticmethod
    def _new_snapshot() -> str:
        return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def read(self) -> DataFrame:
        """All published rows, every version of a key included."""
        _, snapshots = self._generation()
        if not snapshots:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).parquet(*map(self._path, snapshots))

    def latest(self) -> DataFrame:
        """The newest version of every key."""
        return latest_by(self.read(), self.spec.keys, self.spec.version) if self.spec.version else self.read()

    def keys(self, *keys: str, where: Column | str | None = None) -> DataFrame:
        """Distinct keys already loaded, the predicate pushed to the scan."""
        return key_set(self.read(), *(keys or self.spec.keys), where=where)

    def append(self, df: DataFrame) -> None:
        """Add rows, all or none: they lie in a folder of their own, which is published when it is whole."""
        generation, _ = self._generation()
        snapshot = self._new_snapshot()
        self._write(df, snapshot)
        self._publish(snapshot, generation or snapshot)

    def append_once(self, df: DataFrame, delivery: str) -> bool:
        """Add the rows of a named delivery; one that was published before is not stored again.

        What a run that died left of the delivery was never published, and is written anew.
        """
        published = read_or_empty(self.spark, f"{self.root}/published", _PUBLISHED)
        if not published.where(F.col("snapshot") == delivery).isEmpty():
            return False
        generation, _ = self._generation()
        self._write(df, delivery, mode="overwrite")
        self._publish(delivery, generation or self._new_snapshot())
        return True

    def append_new(self, df: DataFrame, guard: str | None = None) -> None:
        """Add only rows whose guard key (by default the first key) is not loaded yet."""
        guard = guard or self.spec.keys[0]
        self.append(without(df, self.keys(guard), guard))

    def replace(self, df: DataFrame, *gates: Gate) -> None:
        """Full refresh: stage a new snapshot, stop if it is empty or a gate fails, publish it.

        Rows are counted while they are written: nothing is read twice.
        """
        snapshot = self._new_snapshot()
        measured, watched = observed(df, *gates)
        self._write(watched, snapshot)
        check(measured, f"the staged snapshot of {self.spec.name}", *gates)
        self._publish(snapshot, snapshot)

    def compact(self) -> None:
        """Replace a versioned table by the newest version of every key; running it again changes nothing.

        An empty table stays as it is.
        """
        newest = self.latest()
        if not newest.isEmpty():
            self.replace(newest)

"""Versioned tables in hash buckets: a compaction reads and writes the buckets that have new versions, and no others.

Every write is a folder with one sub-folder for each bucket it has rows of, and a line in the small ``published`` table
that names it and its buckets. For each bucket the newest compaction and the appends after it count. Nothing is ever
overwritten, and what was not published does not exist for readers. One writer at a time per table.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gamegrain.operators.versions import latest_by
from gamegrain.sinks.contracts import TableSpec, conform
from gamegrain.sinks.tables import read_or_empty

_PUBLISHED = "snapshot string, whole boolean, buckets array<int>"
_BUCKET = "bucket"


@dataclass(frozen=True)
class VersionedTable:
    """A table whose newest version of a key counts, in ``buckets`` by the hash of the key."""

    spark: SparkSession
    root: str
    spec: TableSpec
    buckets: int = 64

    def _valid(self) -> dict[int, list[tuple[str, bool]]]:
        """The folders of each bucket, with whether they are compacted: its last compaction and the appends after it."""
        lines = read_or_empty(self.spark, f"{self.root}/published", _PUBLISHED).collect()
        found: dict[int, list[tuple[str, bool]]] = defaultdict(list)
        for line in sorted(lines, key=lambda r: r.snapshot):
            for bucket in line.buckets:
                part = (f"{self.root}/snapshots/{line.snapshot}/{_BUCKET}={bucket}", line.whole)
                found[bucket] = [part] if line.whole else [*found[bucket], part]
        return found

    def _write(self, df: DataFrame, whole: bool) -> list[int]:
        """Stores and publishes rows; the buckets they fall into are noted while they are written."""
        snapshot = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
        placed = conform(df, self.spec).withColumn(_BUCKET, F.pmod(F.hash(*self.spec.keys), F.lit(self.buckets)))
        noted = Observation()
        watched = placed.observe(noted, F.collect_set(_BUCKET).alias("buckets"))
        rows = watched.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, *self.spec.keys)
        rows.write.partitionBy(_BUCKET).parquet(f"{self.root}/snapshots/{snapshot}")
        buckets = sorted(noted.get["buckets"] or [])
        if buckets:
            line = self.spark.createDataFrame([(snapshot, whole, buckets)], _PUBLISHED)
            line.coalesce(1).write.mode("append").parquet(f"{self.root}/published")
        return buckets

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).parquet(*paths)

    def append(self, df: DataFrame) -> list[int]:
        """Adds versions; gives the buckets that have new ones."""
        return self._write(df, whole=False)

    def read(self) -> DataFrame:
        """All versions that are stored."""
        return self._rows([path for parts in self._valid().values() for path, _ in parts])

    def latest(self) -> DataFrame:
        """The newest version of every key."""
        return latest_by(self.read(), self.spec.keys, self.spec.version)

    def compact(self) -> list[int]:
        """Leaves one version of each key in the buckets that had appends, and gives these buckets.

        Run again it finds no such bucket and changes nothing.
        """
        due = [path for parts in self._valid().values() if not parts[-1][1] for path, _ in parts]
        if not due:
            return []
        return self._write(latest_by(self._rows(due), self.spec.keys, self.spec.version), whole=True)

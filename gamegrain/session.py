"""Session settings and the shared scratch folder.

Nothing here starts a session: every function takes the session of the caller.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Time strings without an offset are read as UTC, and one hot key may hold a third of a table: adaptive execution
# splits such a shuffle partition even where the split costs one more exchange. Documents are read one at a time: as columns,
# thousands of them with all their items are held at once.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on to the given session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own; a cluster has to name one.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gamegrain-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; two runs never share one."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch and read it back: lineage is cut and every later reader sees the same rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables stored by key: joins and aggregations over the key need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, key: str, path: str, buckets: int = BUCKETS, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Stores a table below ``path``, registered as ``name``, in ``buckets`` by the hash of ``key``; gives it back.

    Rows of a bucket go to one task, unless adaptive execution splits what is too big for one: a key with a third of all
    rows is then written by several tasks, into several files of its bucket. Within a file rows are sorted by the key,
    then by ``sort_by``.
    """
    spark = df.sparkSession
    dealt = df.hint("rebalance", buckets, key)  # the hash of a shuffle is that of the buckets
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *sort_by)
    writer.saveAsTable(name)
    return spark.table(name)

"""Files that came since the last run, as a stream that ends when it has read them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gamegrain.sinks.tables import Table


def follow_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    deliver: Callable[[DataFrame, int], None],
    checkpoint: str,
    kind: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> int:
    """Gives the rows of new files below ``path`` to ``deliver(rows, batch)``; tells how many batches there were.

    The log of files lies in ``checkpoint``, a folder that all executors share: files that an earlier run delivered are
    listed, but not opened again. A run that died in the middle of a batch gives the same files under the same batch
    number again, so ``deliver`` has to know a batch that it has stored. With ``files_per_batch`` a backlog comes in
    parts. A folder that does not exist yet has nothing to give.
    """
    reader = spark.readStream.schema(schema).format(kind).options(**options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    batches = []

    def one(rows: DataFrame, batch: int) -> None:
        deliver(rows, batch)
        batches.append(batch)

    stream = reader.load(path).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    return len(batches)


def follow_into(
    table: Table,
    path: str,
    schema: T.StructType | str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    source: str = "files",
    **reading,
) -> int:
    """Appends what ``build`` makes of new files to a table, each batch exactly once.

    ``source`` names the stream: batches of another one have other names in the table.
    """

    def deliver(rows: DataFrame, batch: int) -> None:
        table.append_once(build(rows), f"{source}-{batch:012d}")

    return follow_files(table.spark, path, schema, deliver, checkpoint, **reading)

"""Sinks outside the file system. Both give at-least-once delivery per task: a repeated task sends its rows again,
so the target should replace by key or the load should be guarded by keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import islice

from pyspark.sql import DataFrame, Row


def jdbc_options(*, url: str, user: str, password: str, dbtable: str, driver: str, batchsize: int = 1000) -> dict:
    """Options of a plain batched insert: no transaction, not limited to what JDBC calls compliant."""
    return {
        "url": url,
        "user": user,
        "password": password,
        "dbtable": dbtable,
        "driver": driver,
        "batchsize": str(batchsize),
        "isolationLevel": "NONE",
        "jdbcCompliant": "false",
    }


def write_jdbc(df: DataFrame, *, mode: str = "append", writers: int | None = None, **target) -> None:
    """Append over JDBC through at most ``writers`` connections.

    The bound is a repartition, not a coalesce: the work before it keeps its own parallelism.
    """
    rows = df if writers is None else df.repartition(writers)
    rows.write.format("jdbc").options(**jdbc_options(**target)).mode(mode).save()


def insert_batches(
    df: DataFrame, connect: Callable[[], Callable[[list[Row]], None]], batch_size: int = 1000
) -> None:
    """Send rows, nested arrays included, in batches from the executors that hold them.

    ``connect`` runs once per partition there and returns the function that inserts one batch.
    """

    def send(rows: Iterable[Row]) -> None:
        rows = iter(rows)
        insert = None
        while batch := list(islice(rows, batch_size)):
            insert = insert or connect()
            insert(batch)

    df.foreachPartition(send)

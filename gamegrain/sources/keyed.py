"""Documents of wanted keys, read from the blocks that hold them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.operators.keys import only
from gamegrain.sinks.documents import wide_block

BLOCK = "block"


def keyed_scan(
    stored: DataFrame, keys: DataFrame, key: str, block_keys: int, block: str = BLOCK, wide_keys: int | None = None
) -> DataFrame:
    """Documents whose key is wanted, from storage that is split into blocks of ``block_keys`` neighbouring keys, and into
    those of ``wide_keys`` if some loads were put there.

    The wanted blocks, and the smallest and largest key, are scalar subqueries over the key frame. Spark runs them
    before the scan: folders of other blocks are not listed, and row groups outside the keys are not read. What is left
    goes through a semi join. A document without a block (a folder that is not split) is read.
    """
    wanted = keys.select(F.col(key).cast("bigint").alias(key)).dropna()
    numbers = [F.floor(F.col(key) / block_keys).cast("bigint"), *([] if wide_keys is None else [wide_block(key, wide_keys)])]
    blocks = [wanted.select(F.collect_set(number)).scalar() for number in numbers]
    low, high = (wanted.select(f(key)).scalar() for f in (F.min, F.max))
    held = F.col(block).isNull()
    for own in blocks:
        held |= F.array_contains(own, F.col(block))
    return only(stored.where(held).where((F.col(key) >= low) & (F.col(key) <= high)), wanted, key)

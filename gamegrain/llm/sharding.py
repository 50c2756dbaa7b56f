"""Longest-processing-time sharding of groups that must stay together."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import ROW, numbered, prepare, ranked, text_of, write_out

# Joins are planned alike at every size, so a run on a part of the data tells what the whole needs.
SHUFFLE = "shuffle_merge"


def deal(loads: list[int], load: int, times: int) -> list[int]:
    """How many of ``times`` items of one load each shard gets, if each item goes to the shard with the least load so
    far (ties: lower shard).

    Shard s takes its items at the loads ``loads[s]``, ``loads[s] + load`` and so on. The items in question are the
    ``times`` smallest of these numbers, so a level is searched below which they lie.
    """
    shards = range(len(loads))
    if load == 0:  # the least loaded shard stays the least loaded one
        least = min(shards, key=loads.__getitem__)
        return [times if s == least else 0 for s in shards]

    def below(level: int) -> list[int]:
        return [max(0, -(-(level - had) // load)) for had in loads]

    low, high = min(loads), min(loads) + load * times + 1
    while low < high:  # the largest level below which at most ``times`` items lie
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(below(middle)) <= times else (low, middle - 1)
    got = below(low)
    rest = times - sum(got)
    for s in shards:  # the others are taken at the level itself
        if rest and (at := loads[s] + got[s] * load) == low:
            got[s] += 1
            rest -= 1
    return got


def schedule(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """``load, first, last, shard``: which places among the items of each load go to which shard.

    ``runs`` are loads with the number of items that have them. Items go by falling load to the shard with the least
    load so far. Few items of a load are dealt by a heap, one after the other; many are dealt at once, which gives each
    shard as many.
    """
    loads, out = [0] * shards, []
    heap = [(0, shard) for shard in range(shards)]
    for load, times in sorted(runs, reverse=True):
        if times <= 4 * shards:
            got = [0] * shards
            for _ in range(times):
                least, shard = heap[0]
                heapq.heapreplace(heap, (least + load, shard))
                got[shard] += 1
        else:
            got = deal(loads, load, times)
        first = 0
        for shard, n in enumerate(got):
            if n:
                out.append((load, first, first + n, shard))
                loads[shard] += n * load
                first += n
        if times > 4 * shards:
            heap = [(had, shard) for shard, had in enumerate(loads)]
            heapq.heapify(heap)
    return out


def lpt_shards(df: DataFrame, group: Column, size: Column, shards: int, *carry: str | Column) -> DataFrame:
    """Rows with ``size``, ``shard`` and ``slot`` (gapless place in the shard, from 0), and the columns in ``carry``.

    Rows with equal ``group`` share a shard. Loads are summed before anything is sent; the driver sees each different
    load once, with the number of groups that have it: with a total load of T these are fewer than the root of 2 T,
    whatever the number of groups. All groups are scheduled longest first. A group larger than a fair share stays whole
    and fills its shard alone. Equal loads are told apart by the digests of their groups. Empty table: empty result. NULL
    groups are a group of their own. Of a very long group value only the digest is kept.
    """
    spark = prepare(df.sparkSession)
    key = F.unhex(F.sha2(F.coalesce(group.cast("binary"), F.lit(b"\x00null")), 256))
    rows = numbered(df.select(*carry, size.cast("long").alias("size"), key.alias("_group")), "shard-rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_load"))
    groups = write_out(groups.withColumn(ROW, F.xxhash64("_group")), "shard-groups")
    runs = [(r[0], r[1]) for r in groups.groupBy("_load").count().collect()]
    plan = pd.DataFrame(schedule(runs, shards), columns=["_load", "_first", "_last", "shard"], dtype=np.int64)
    plan = spark.createDataFrame(plan, "_load long, _first long, _last long, shard int")
    placed = ranked(groups, "_load", "_place").hint(SHUFFLE).join(plan, "_load")
    placed = placed.where((F.col("_place") >= F.col("_first")) & (F.col("_place") < F.col("_last"))).select("_group", "shard")
    sharded = rows.hint(SHUFFLE).join(placed, "_group").drop("_group")
    return ranked(sharded, "shard", "slot").drop(ROW)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row, repeated rows included.

    Groups are equal texts (NULL as empty); size is the UTF-8 length plus 8; the law is ``bytes``.
    """
    text = text_of()
    sharded = lpt_shards(
        docs, text, F.octet_length(text) + 8, shards,
        F.col("doc_id").cast("long").alias("doc_id"), F.crc32(text).alias("text_crc32"),
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

"""Exact deduplication against an index of texts seen before."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import ROW, ascii_lower, numbered, prepare, text_of, write_out
from gamegrain.llm.perfect import PerfectHash

# Distinct digests per index shard: a shard is one binary row of some megabytes.
KEYS_PER_SHARD = 50_000

INDEX = "shard long, hash binary, digests binary, ids binary, has_ids binary, rows binary, sizes binary"
CLASSES = "digest binary, win_has boolean, win_id long, win_row long, group_size long"


def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First 16 bytes of each 32-byte digest as two integers."""
    pairs = digests.reshape(-1, 32)[:, :16].copy().view("<u8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


def _digest_array(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner (largest ``doc_id``, then largest row number) and the number of rows.

    Aggregated before the shuffle, so a group of copies sends one row per task.
    """
    winner = F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), F.coalesce("doc_id", F.lit(0)).alias("id"), ROW))
    grouped = rows.groupBy("digest").agg(winner.alias("w"), F.count("*").alias("group_size"))
    return grouped.select(
        "digest", F.col("w.has").alias("win_has"), F.col("w.id").alias("win_id"), F.col(f"w.{ROW}").alias("win_row"),
        "group_size",
    )


def with_shard(classes: DataFrame, shards: int) -> DataFrame:
    return classes.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the hash, and per slot the full digest and the winner it leads to."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        digests = _digest_array(pdf["digest"])
        low, high = _words(digests)
        table = PerfectHash.build(low, high)
        order = np.argsort(table.slots(low, high))
        column = {
            "ids": pdf["win_id"].to_numpy(np.int64), "has_ids": pdf["win_has"].to_numpy(bool),
            "rows": pdf["win_row"].to_numpy(np.int64), "sizes": pdf["group_size"].to_numpy(np.int64),
        }
        row = {"shard": [int(pdf["shard"].iloc[0])], "hash": [table.to_bytes()], "digests": [digests[order].tobytes()]}
        return pd.DataFrame(row | {name: [values[order].tobytes()] for name, values in column.items()})

    return with_shard(history, shards).groupBy("shard").applyInPandas(build, INDEX)


def look_up(classes: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """``CLASSES`` of the indexed digests, new rows that are members counted in. Digests of nonmembers are not among them.

    A slot counts as a hit only if the whole digest in it is the same, byte for byte.
    """
    names = [field.split()[0] for field in CLASSES.split(", ")]

    def merge(new: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(stored):  # nothing is indexed here
            return pd.DataFrame(columns=names)
        entry = stored.iloc[0]
        old = np.frombuffer(entry["digests"], np.uint8).reshape(-1, 32)
        o_ids, o_rows, o_sizes = (np.frombuffer(entry[k], np.int64).copy() for k in ("ids", "rows", "sizes"))
        o_has = np.frombuffer(entry["has_ids"], bool).copy()
        if len(new):
            digests = _digest_array(new["digest"])
            slot = PerfectHash.from_bytes(entry["hash"]).slots(*_words(digests))
            member = slot >= 0
            member[member] = (old[slot[member]] == digests[member]).all(axis=1)
            at = slot[member]
            has, ids = new["win_has"].to_numpy(bool)[member], new["win_id"].to_numpy(np.int64)[member]
            rows = new["win_row"].to_numpy(np.int64)[member]
            o_sizes[at] += new["group_size"].to_numpy(np.int64)[member]
            later = np.array(
                [(a, b, c) > (d, e, f) for a, b, c, d, e, f in zip(
                    has, ids, rows, o_has[at], o_ids[at], o_rows[at], strict=True)], bool,
            )
            for mine, newer in ((o_has, has), (o_ids, ids), (o_rows, rows)):
                mine[at[later]] = newer[later]
        return pd.DataFrame({"digest": [d.tobytes() for d in old], "win_has": o_has, "win_id": o_ids, "win_row": o_rows,
                             "group_size": o_sizes})

    new = with_shard(classes, shards).groupBy("shard")
    return new.cogroup(index.groupBy("shard")).applyInPandas(merge, CLASSES)


def shards_for(*classes: DataFrame) -> int:
    """Shards such that no task gets much more than ``KEYS_PER_SHARD`` digests, old or new."""
    return max(1, *(-(-found.count() // KEYS_PER_SHARD) for found in classes))


def exact_classes(docs: DataFrame, history: Column, *carry: Column) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``, and the columns in ``carry``.

    Rows where ``history`` holds are the texts seen before: their distinct digests make the index. All others are
    looked up in it; nonmembers stay the groups that Spark has made of them. Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The row with the
    largest ``doc_id`` stays (NULL ids lose); of rows that repeat that id, one stays. Of a very long text only the digest is kept. Empty table:
    empty result.
    """
    prepare(docs.sparkSession)
    digest = F.unhex(F.sha2(ascii_lower(text_of()), 256))
    rows = numbered(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"),
                    F.coalesce(history, F.lit(False)).alias("seen"), F.struct(F.lit(0).alias("-"), *carry).alias("carried")),
        "digests",
    )
    old = write_out(classes_of(rows.where("seen")), "history")
    new = write_out(classes_of(rows.where("NOT seen")), "new-classes")
    shards = shards_for(old, new)
    index = write_out(build_index(old, shards), "digest-index")
    indexed = write_out(look_up(new, index, shards), "indexed-classes")
    nonmembers = new.join(indexed.select("digest"), "digest", "left_anti")
    joined = rows.drop("seen").join(indexed.unionByName(nonmembers), "digest")
    carried = [F.col("carried").getField(name).alias(name) for name in rows.schema["carried"].dataType.names[1:]]
    return joined.select(
        "doc_id", *carried, F.when(F.col("win_has"), F.col("win_id")).alias("keep_id"), "group_size",
        (F.col(ROW) == F.col("win_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def older_half() -> Column:
    """Stands for an earlier delivery: half of the ids, by checksum."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, dropped ones too."""
    return exact_classes(docs, older_half())

"""Near-duplicates by SimHash: fingerprints as bit counts of small segments, joined in a grid, verified bit by bit."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import prepare, write_out
from gamegrain.llm.components import components

WORDS = 3  # words of a shingle
SEED = 42
DISTANCE = 3  # differing bits of linked fingerprints
SEGMENT = 2  # bits of a segment: it counts 0, 1 or 2
# Entries of a grid cell that are compared at once. A fuller cell is dealt to blocks, and each pair of blocks is a task.
BLOCK = 1_000
SUMMED = 1 << 14  # shingles whose bits are summed at once
# Joins are planned alike at every size, so a run on a part of the data tells what the whole needs.
SHUFFLE = "shuffle_merge"

_LOW_BITS = np.uint64(0x5555555555555555)
_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: bytes | None) -> int:
    """64 bits; a bit is 1 if it is set in over half the digests of the shingles. No words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    runs = [words] if len(words) < WORDS else zip(*(words[i:] for i in range(WORDS)), strict=False)
    n = max(1, len(words) - WORDS + 1)
    digests = np.fromiter(map(_digest, map(b" ".join, runs)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SUMMED):
        octets = digests[at : at + SUMMED].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, print``: the fingerprint as a signed integer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = np.array([*map(fingerprint, pdf["text"])], np.uint64).astype(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "print": found})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, "doc_id long, print long")


def _bits(value: int) -> Column:
    """A literal with these 64 bits."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def segment_counts(prints: Column) -> Column:
    """The bit counts of all segments, each in the bits of its segment."""
    low = _bits(int(_LOW_BITS))
    high, rest = F.shiftrightunsigned(prints, 1).bitwiseAND(low), prints.bitwiseAND(low)
    return F.shiftleft(high.bitwiseAND(rest), 1).bitwiseOR(high.bitwiseXOR(rest))


def grid_cells(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``cell, print, own``: the cells of each fingerprint, one part of the segments at a time.

    The Manhattan distance between the counts is at most the number of differing bits. Over ``distance // 2 + 1``
    parts it is at most one in some part. There the counts are equal, and both fingerprints have the same cell as
    their own, or one count is greater by one, and the fingerprint that has less there also goes to the cell of the
    other. So a link always meets in a cell that is the own one of at least one of its ends.
    """
    parts, segments = distance // 2 + 1, 64 // SEGMENT
    counts = F.col("counts")
    entries = []
    for part in range(parts):
        first, last = part * segments // parts, (part + 1) * segments // parts
        mask = sum(((1 << SEGMENT) - 1) << SEGMENT * i for i in range(first, last))
        here = counts.bitwiseAND(_bits(mask))
        entries.append(F.struct(F.lit(part).alias("part"), here.alias("counts"), F.lit(True).alias("own")))
        for i in range(first, last):
            one, two = (counts.bitwiseAND(_bits(n << SEGMENT * i)) != 0 for n in (1, 2))
            more = here.bitwiseXOR(F.when(one, _bits(3 << SEGMENT * i)).otherwise(_bits(1 << SEGMENT * i)))
            entry = F.struct(F.lit(part).alias("part"), more.alias("counts"), F.lit(False).alias("own"))
            entries.append(F.when(~two, entry))
    placed = prints.withColumn("counts", segment_counts(F.col("print")))
    placed = placed.select("print", F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
    return placed.select(F.struct("e.part", "e.counts").alias("cell"), "print", "e.own")


def thermometer(prints: np.ndarray) -> np.ndarray:
    """Counts 0, 1, 2 as the bits 00, 01, 11: differing bits of two such numbers are the distance of their counts."""
    low, high = prints & _LOW_BITS, (prints >> np.uint64(1)) & _LOW_BITS
    return (low | high) | ((low & high) << np.uint64(1))


def spanning_links(rows: np.ndarray, columns: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between fingerprints in two lists, as few as connect what all their links connect."""
    # The distance of the counts bounds the other from below, so only what it lets through is verified.
    near_r, near_c = np.nonzero(np.bitwise_count(thermometer(rows)[:, None] ^ thermometer(columns)[None, :]) <= distance)
    linked = np.bitwise_count(rows[near_r] ^ columns[near_c]) <= distance
    near_r, near_c = near_r[linked], near_c[linked]
    owner, tree, links = np.full(len(columns), -1), np.arange(len(rows)), []
    starts = np.searchsorted(near_r, np.arange(len(rows) + 1))
    for row in np.unique(near_r).tolist():
        met = near_c[starts[row] : starts[row + 1]]
        owners = owner[met]
        new = met[owners < 0]
        links += [(rows[row], columns[c]) for c in new.tolist()]
        old = met[owners >= 0]
        trees, first = np.unique(tree[owner[old]], return_index=True)
        links += [(rows[row], columns[c]) for c in old[first].tolist()]
        owner[new] = row
        tree[np.isin(tree, trees)] = row
    return [(int(a), int(b)) for a, b in links if a != b]


def grid_links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect the same fingerprints as all links do; no cell gives all its pairs."""
    entries = write_out(grid_cells(prints, distance), "cells")
    full = entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("own").alias("owned"))
    full = full.where("owned AND n > 1").select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    met = entries.hint(SHUFFLE).join(full, "cell")
    met = met.withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = [F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    item = F.struct("print", "own", (F.col("block") > F.col("other")).alias("upper"))
    pairs = met.groupBy("cell", *sides).agg(F.collect_list(item).alias("items")).where("size(items) > 1")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for same, items in zip(pdf["same"], pdf["items"], strict=True):
                prints = np.array([i["print"] for i in items], np.int64).astype(np.uint64)
                own = np.array([i["own"] for i in items], bool)
                upper = np.array([i["upper"] for i in items], bool)
                if same:
                    out += spanning_links(prints[own], prints, distance)
                else:
                    out += spanning_links(prints[own & ~upper], prints[upper], distance)
                    out += spanning_links(prints[own & upper], prints[~upper], distance)
            yield pd.DataFrame(np.array(out, np.uint64).astype(np.int64).reshape(-1, 2), columns=["a", "b"])

    return pairs.select((F.col("low") == F.col("high")).alias("same"), "items").mapInPandas(run, "a long, b long")


def simhash_components(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest ``doc_id`` among all rows
    that links connect. Equal fingerprints are one node. A NULL or empty text, or one of white space, has the
    fingerprint zero, which links like any other; texts of fewer than three words are one shingle. NULL ids are never
    the smallest; a component of NULL ids only has none. Repeated rows each give their row; an empty table gives an
    empty result; other columns are not read. A very long text is one row; its shingles are summed in parts.
    """
    prepare(docs.sparkSession)
    rows = write_out(fingerprints(docs), "fingerprints")
    nodes = write_out(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "nodes")
    labels = write_out(components(write_out(grid_links(nodes.select("print"), distance), "links")), "labels")
    linked = labels.withColumnRenamed("node", "print").hint(SHUFFLE).join(nodes, "print")
    firsts = linked.groupBy("label").agg(F.min("first_id").alias("component_id"))
    joined = linked.hint(SHUFFLE).join(firsts, "label").select("print", "component_id")
    placed = nodes.hint(SHUFFLE).join(joined, "print", "left")
    placed = placed.select("print", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.hint(SHUFFLE).join(placed, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )

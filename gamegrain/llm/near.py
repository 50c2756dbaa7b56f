"""Near-duplicates by Order MinHash, with candidates verified by banded alignment."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import ROW, SHUFFLE, numbered, prepare, text_of, write_out
from gamegrain.llm.components import components

WORDS = 5  # words of a shingle
SIMILARITY = 0.8
# A sketch keeps the PICKS smallest shingles in text order. Two texts of similarity 0.8 agree in a sketch with
# probability 0.41, so they miss each other in all SKETCHES with 3 in a million. That needs many shingles: of few, the
# smallest ones are too likely those that only one of the texts has. So texts of up to SHORT shingles have sketches of
# FEW_PICKS, with which two texts miss each other with 3 in ten billion at most (4 against 5 shingles). Texts that a short
# one may be near to, up to a quarter longer, have both kinds.
PICKS, SKETCHES = 4, 24
SHORT, FEW_PICKS = 25, 2
# Counters that tell common shingles from rare ones. They decide an order only: any values give the same links.
SLOTS, BLOCKS = 1 << 20, 64
MEMO = 400_000

_SEEDS = np.random.default_rng(20).integers(1, 2**63, SKETCHES).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _MIX
    return (x ^ (x >> _SHIFT)) * _ODD


class Shingles:
    """Texts as arrays of shingle digests in text order. The n-th occurrence of a shingle has a digest of its own."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words, memo = text.lower().split(), self.memo
        missing = [w for w in set(words) if w not in memo]
        if len(memo) + len(missing) > MEMO:
            memo.clear()
            missing = set(words)
        for word in missing:
            memo[word] = xxhash.xxh3_64_intdigest(word)
        w = np.array([*map(memo.__getitem__, words)], np.uint64)
        if len(w) < WORDS:  # a short text is one shingle of all its words
            return np.array([xxhash.xxh3_64_intdigest(w.tobytes())], np.uint64)
        grams = np.zeros(len(w) - WORDS + 1, np.uint64)
        for i in range(WORDS):
            grams = _mix(grams + w[i : len(grams) + i])
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if not first.all():
            at = np.arange(len(grams))
            times = np.empty(len(grams), np.uint64)
            times[order] = at - np.maximum.accumulate(np.where(first, at, 0))
            grams = np.where(times > 0, _mix(grams + times * _ODD), grams)
        return grams


def sketch(grams: np.ndarray) -> np.ndarray:
    """One key for each sketch: its smallest shingles, in the order in which the text has them."""
    values, keys = _mix(grams[None, :] ^ _SEEDS[:, None]), []
    for picks, wanted in ((FEW_PICKS, len(grams) * SIMILARITY <= SHORT), (PICKS, len(grams) > SHORT)):
        if not wanted:
            continue
        if len(grams) > picks:
            picked = np.sort(np.argpartition(values, picks - 1, axis=1)[:, :picks], axis=1)
            kept = grams[picked]
        else:
            kept = np.repeat(grams[None, :], SKETCHES, axis=0)
        key = _SEEDS + np.uint64(picks)
        for i in range(kept.shape[1]):
            key = _mix(key + kept[:, i])
        keys.append(key)
    return np.unique(np.concatenate(keys)).astype(np.int64)


def needed(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Shared shingles that texts of n and m shingles need for the similarity (shared over all)."""
    return math.ceil(similarity * (n + m) / (1 + similarity) - 1e-9)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Shared shingles along the best alignment, over all shingles; 0 if it cannot reach ``least``.

    The alignment is the longest chain of shared shingles that goes forward in both texts. Only pairs within the band
    count: a chain that is long enough leaves out n + m - 2 s shingles, so it never leaves that diagonal band.
    """
    n, m = len(a), len(b)
    want = needed(n, m, least)
    if want > min(n, m):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    inside = np.abs(i - j) <= n + m - 2 * want
    i, j = i[inside], j[inside]
    if len(i) < want:
        return 0.0
    j = j[np.argsort(i)]
    if (j[1:] > j[:-1]).all():
        shared = len(j)
    else:
        tails: list[int] = []
        for at in j.tolist():
            place = bisect_left(tails, at)
            tails[place : place + 1] = [at]
        shared = len(tails)
    return shared / (n + m - shared) if shared >= want else 0.0


def _sketches(rows: DataFrame) -> DataFrame:
    """Row, digest of its shingles (equal digests: equal texts for this purpose) and the keys of its sketches."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for pdf in parts:
            same, keys = [], []
            for text in pdf["text"]:
                grams = shingles(text)
                same.append(xxhash.xxh3_128_digest(grams.tobytes()))
                keys.append(sketch(grams))
            yield pd.DataFrame({ROW: pdf[ROW], "same": same, "keys": keys})

    return rows.select(ROW, "text").mapInPandas(run, f"{ROW} long, same binary, keys array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs with ``linked``: whether their alignment reaches the similarity."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, last, grams = Shingles(), None, None
        for pdf in parts:
            linked = []
            for a, text_a, text_b in zip(pdf["a"], pdf["text_a"], pdf["text_b"], strict=True):
                if a != last:
                    last, grams = a, shingles(text_a)
                linked.append(similarity(grams, shingles(text_b), least) > 0)
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "linked": linked})

    of_a = texts.select(F.col(ROW).alias("a"), F.col("text").alias("text_a"))
    of_b = texts.select(F.col(ROW).alias("b"), F.col("text").alias("text_b"))
    met = pairs.hint(SHUFFLE).join(of_b, "b").hint(SHUFFLE).join(of_a, "a")
    return met.mapInPandas(run, "a long, b long, linked boolean")


def _rest(failed: DataFrame, members: DataFrame, labels: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs that a bucket's centre did not decide: texts that failed there, against all texts of these buckets.

    Prefix filtering, which is exact: shingles are ordered from rare to common, and two texts can only share enough
    of them if they share one among their first n - needed + 1. An independent edit makes shingles that nobody else
    has, so far texts of one large group do not meet. Pairs of one component are left out.
    """
    spark = failed.sparkSession
    near = members.join(failed.select("key").distinct(), "key", "left_semi").select(ROW).distinct()
    near = near.join(failed.select(F.col("b").alias(ROW)).distinct().withColumn("failed", F.lit(True)), ROW, "left")
    some = texts.join(near.hint(SHUFFLE), ROW).join(labels.select(F.col("node").alias(ROW), "label"), ROW, "left")
    some = write_out(some.select(ROW, "text", F.coalesce("label", ROW).alias("label"), F.coalesce("failed", F.lit(False)).alias("failed")), "rest")
    width = SLOTS // BLOCKS

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, slots = Shingles(), np.zeros(SLOTS, np.int64)
        for pdf in parts:
            for text in pdf["text"]:
                np.add.at(slots, (shingles(text) % np.uint64(SLOTS)).astype(np.int64), 1)
        yield pd.DataFrame({"block": range(BLOCKS), "n": [slots[i * width : (i + 1) * width].astype(np.int32).tobytes() for i in range(BLOCKS)]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        summed = sum(np.frombuffer(n, np.int32).astype(np.int64) for n in pdf["n"])
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "n": [summed.tobytes()]})

    counted = some.select("text").mapInPandas(count, "block int, n binary")
    blocks = counted.groupBy("block").applyInPandas(total, "block int, n binary").collect()
    table = np.zeros(SLOTS, np.int64)
    for row in blocks:
        table[row.block * width : (row.block + 1) * width] = np.frombuffer(row.n, np.int64)
    shared = spark.sparkContext.broadcast(table)

    def prefixes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, counts = Shingles(), shared.value
        for pdf in parts:
            out = []
            for row, text, label, bad in zip(pdf[ROW], pdf["text"], pdf["label"], pdf["failed"], strict=True):
                grams = shingles(text)
                n = len(grams)
                grams = grams[np.lexsort((grams, counts[(grams % np.uint64(SLOTS)).astype(np.int64)]))]
                first = grams[: n - needed(n, math.ceil(least * n), least) + 1].astype(np.int64)
                out.append(pd.DataFrame({"gram": first, "at": np.arange(len(first)), ROW: row, "n": n, "label": label, "failed": bad}))
            if out:
                yield pd.concat(out)

    rows = some.mapInPandas(prefixes, f"gram long, at int, {ROW} long, n int, label long, failed boolean")
    rows = write_out(rows, "prefixes")
    left = rows.where("failed").toDF("gram", "at_b", "b", "n_b", "label_b", "failed_b")
    right = rows.toDF("gram", "at_a", "a", "n_a", "label_a", "failed_a")
    spare = F.ceil(F.lit(least) * (F.col("n_a") + F.col("n_b")) / (1 + least) - 1e-9)
    met = left.join(right, [left.gram == right.gram, F.col("label_a") != F.col("label_b"),
                            F.col("at_a") <= F.col("n_a") - spare, F.col("at_b") <= F.col("n_b") - spare])
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_classes(docs: DataFrame, whole: bool = False, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row, and with ``whole`` the row itself as ``document``.

    Texts are compared by five-word shingles of the lower-cased words; texts of fewer words are near only if their
    words are the same. Links join texts whose aligned shingles make up 0.8 or more of all; classes are what links
    connect. NULL counts as empty; empty texts are copies of each other. Of a class the row with the smallest
    ``doc_id`` stays (NULL ids lose), and gives ``class_id``; of repeated rows one stays. Empty table: empty result.

    Copies are collapsed first. In each bucket of equal sketch keys all texts are aligned with one centre: the text
    whose other buckets are the fullest, since independent edits leave it closest to all. What fails there goes
    through ``_rest``. So a bucket of any size gives one pair a text. A very long text is one row with the same number
    of sketches as any.
    """
    prepare(docs.sparkSession)
    row = F.struct("*") if whole else F.struct("text")
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("document")), "near-rows")
    rows = rows.withColumn("text", text_of("document.text"))
    sketches = write_out(_sketches(rows), "sketches")
    copies = write_out(sketches.groupBy("same").agg(F.min(ROW).alias("_first")), "copies")
    single = sketches.join(copies.select(F.col("_first").alias(ROW)), ROW, "left_semi")
    members = write_out(single.select(ROW, F.explode("keys").alias("key")), "members")
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = write_out(members.join(sizes, "key"), "bucketed")
    weight = members.groupBy(ROW).agg(F.sum(F.log2("n")).alias("weight"))
    centres = members.join(weight, ROW).groupBy("key").agg(F.max_by(ROW, F.struct("weight", F.xxhash64(ROW, "key"))).alias("a"))
    spokes = write_out(members.join(centres, "key").select("key", "a", F.col(ROW).alias("b")).where("a <> b"), "spokes")
    wanted = members.select(ROW).distinct().hint(SHUFFLE)
    texts = write_out(rows.select(ROW, "text").join(wanted, ROW, "left_semi"), "candidates")
    tested = write_out(_verified(spokes.select("a", "b").distinct(), texts, least), "tested")
    links = tested.where("linked").select("a", "b")
    labels = components(links)
    apart = tested.where("NOT linked")
    for end in ("a", "b"):
        apart = apart.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}")), end, "left")
    apart = apart.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    failed = write_out(spokes.join(apart, ["a", "b"], "left_semi").select("key", "b"), "failed")
    if not failed.isEmpty():
        more = _verified(_rest(failed, members, labels, texts, least), texts, least)
        more = write_out(more.where("linked").select("a", "b"), "more-links")
        labels = components(links.union(more))
    classes = copies.join(labels.select(F.col("node").alias("_first"), "label"), "_first", "left")
    classes = classes.select("same", F.coalesce("label", "_first").alias("label"))
    placed = sketches.select(ROW, "same").join(classes, "same").select(ROW, "label")
    placed = write_out(placed.join(rows.select(ROW, "doc_id"), ROW), "placed")
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW))
    groups = placed.groupBy("label").agg(winner.alias("w"), F.count("*").alias("class_size"))
    decided = placed.join(groups, "label").select(
        ROW, F.col("w.doc_id").alias("class_id"), "class_size", (F.col(ROW) == F.col(f"w.{ROW}")).alias("kept")
    )
    if not whole:
        return placed.drop("label").join(decided, ROW).drop(ROW)
    return rows.join(decided, ROW).select("doc_id", "document", "class_id", "class_size", "kept")

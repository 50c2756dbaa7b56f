"""Approximate nearest neighbours by adaptive dimension scan over probed lists.

Largest inner product becomes smallest distance by one more dimension, which gives all vectors the same length. A
random rotation spreads that distance evenly over the dimensions, so the first of them estimate all: a candidate is
abandoned as soon as its partial distance is too large for its rank, by a hypothesis test.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamegrain.llm.common import ROW, numbered, prepare, ranked, write_out

# The lists' centres are fitted on at most SAMPLE vectors; every vector is indexed. There are as many lists as vectors in
# a list, up to MOST_LISTS; beyond its square, lists grow longer.
SAMPLE, MOST_LISTS = 20_000, 2_048
# At least PROBES lists are probed, and so many that they hold RECALL of the true neighbours of at most TRIALS queries,
# found by brute force.
PROBES, RECALL, TRIALS = 4, 0.95, 128
# Nearest lists of a query that are scanned before its reach is taken anew.
ROUNDS = (1, 8)
BLOCK, QUERY_BLOCK = 1_024, 128  # vectors and queries in one row of the index
COLUMNS = 16  # dimensions between two tests
CONFIDENCE = 2.1  # of the test, in deviations at one dimension
IDS_PER_SALT = 100_000


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))[0]


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Rotated vectors with the dimension that gives all of them the length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0))
    return np.column_stack([vectors, rest]) @ rotation(vectors.shape[1] + 1)


def lifted_queries(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors, np.zeros(len(vectors))]) @ rotation(vectors.shape[1] + 1)


def usable(df: DataFrame, vector: str, key: str) -> DataFrame:
    """``vec_id, vector`` of rows that take part: of the usual dimension, finite, not all zero, each id once."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.where(F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return rows
    # -0.0 and 0.0 are one number.
    return rows.where(F.size("vector") == sizes[0].size).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids, all that a query for k can return of them.

    A vector that many rows share is collected in salted parts first, so no task holds all its ids.
    """
    salts = max(1, -(-rows.count() // IDS_PER_SALT))

    def smallest(ids) -> F.Column:
        return F.slice(F.sort_array(F.array_distinct(ids)), 1, k + 1).alias("ids")

    parts = rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("_salt")).agg(smallest(F.collect_list("vec_id")))
    whole = parts.groupBy("vector").agg(smallest(F.flatten(F.collect_list("ids"))))
    return numbered(whole, "vectors").withColumnRenamed(ROW, "cid")


def centres_of(vectors: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """k-means from a seeded start; an empty list moves to the vector that is farthest from its centre."""
    rng = np.random.default_rng(1)
    centres = vectors[rng.choice(len(vectors), lists, replace=False)]
    for _ in range(rounds):
        distance = (centres**2).sum(axis=1) - 2 * vectors @ centres.T
        at = distance.argmin(axis=1)
        n = np.bincount(at, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, vectors)
        far = np.argsort(-(distance[np.arange(len(at)), at] + (vectors**2).sum(axis=1)))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        empty = np.nonzero(n == 0)[0]
        centres[empty] = vectors[far[: len(empty)]]
    return centres


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def abandon(vectors: np.ndarray, queries: np.ndarray, reaches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place of a query, place of a vector) that may be within the query's ``reach``, a squared distance.

    After each column block the partial distance, scaled to all dimensions, is tested; later columns are read for the
    remaining pairs only. The first block is a product of matrices, since no pair has been abandoned there.
    """
    size = queries.shape[1]

    def bound(end: int) -> np.ndarray:
        scaled = reaches if end == size else reaches * (1 + CONFIDENCE / np.sqrt(end)) ** 2 * end / size
        return scaled * (1 + 1e-9)

    end = min(size, COLUMNS)
    x, q = vectors[:, :end], queries[:, :end]
    partial = (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2 * q @ x.T
    at, rows = np.nonzero(partial <= bound(end)[:, None] + 1e-9)
    partial = partial[at, rows]
    while end < size and len(rows):
        start, end = end, min(size, end + COLUMNS)
        apart = vectors[rows, start:end] - queries[at, start:end]
        partial = partial + np.einsum("ij,ij->i", apart, apart)
        near = partial <= bound(end)[at]
        at, rows, partial = at[near], rows[near], partial[near]
    return at, rows


INDEX = "list int, block long, cids binary, firsts binary, vectors binary, columns binary"
FOUND = "qcid long, cid long, first long, score double"


def build_index(classes: DataFrame, centres: np.ndarray, longest: float) -> DataFrame:
    """Every vector in its nearest list, in blocks; a block keeps the original vectors and the rotated columns."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for pdf in parts:
            if len(pdf):
                x = lifted(stacked(pdf["vector"]), longest)
                pdf["list"] = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1).astype(np.int32)
                yield pdf

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid")
        x = stacked(pdf["vector"])
        return pd.DataFrame({
            "list": [int(pdf["list"].iloc[0])], "block": [int(pdf["block"].iloc[0])],
            "cids": [pdf["cid"].to_numpy(np.int64).tobytes()], "firsts": [pdf["first"].to_numpy(np.int64).tobytes()],
            "vectors": [x.astype(np.float32).tobytes()], "columns": [lifted(x, longest).T.astype(np.float32).tobytes()],
        })

    narrow = classes.select("cid", F.col("ids")[0].alias("first"), "vector")
    assigned = write_out(narrow.mapInPandas(assign, "cid long, first long, vector array<float>, list int"), "assigned")
    placed = ranked(assigned.withColumn(ROW, F.col("cid")), "list", "_at").drop(ROW)
    blocks = placed.withColumn("block", F.floor(F.col("_at") / BLOCK)).drop("_at")
    return write_out(blocks.groupBy("list", "block").applyInPandas(pack, INDEX), "lists")


def probes_needed(queries: DataFrame, index: DataFrame, centres: np.ndarray, k: int) -> int:
    """Nearest lists that hold RECALL of the k + 1 best vectors in the whole index, over at most TRIALS queries.

    A task keeps the best of its blocks only, so each sends k + 1 rows a query.
    """
    tried = queries.orderBy(F.xxhash64("cid")).select("vector").limit(TRIALS).toPandas()["vector"]
    if not len(tried):
        return 1
    q = stacked(tried)
    order = ((centres**2).sum(axis=1) - 2 * lifted_queries(q) @ centres.T).argsort(axis=1)
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.arange(len(centres))[None, :], axis=1)
    shared = queries.sparkSession.sparkContext.broadcast((q, places))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, places = shared.value
        best, at = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64)
        for pdf in parts:
            for row in pdf.itertuples():
                x = np.frombuffer(row.vectors, np.float32).reshape(-1, q.shape[1]).astype(np.float64)
                best = np.concatenate([best, q @ x.T], axis=1)
                at = np.concatenate([at, np.repeat(places[:, row.list, None], len(x), axis=1)], axis=1)
                if best.shape[1] > k + 1:
                    top = np.argpartition(-best, k, axis=1)[:, : k + 1]
                    best, at = np.take_along_axis(best, top, axis=1), np.take_along_axis(at, top, axis=1)
        query = np.repeat(np.arange(len(q)), best.shape[1])
        yield pd.DataFrame({"query": query, "score": best.ravel(), "place": at.ravel()})

    found = index.select("list", "vectors").mapInPandas(run, "query int, score double, place long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "place"))
    best = found.withColumn("_n", rank).where(F.col("_n") <= k + 1)
    held = np.zeros(len(centres))
    for row in best.groupBy("place").count().collect():
        held[row.place] = row["count"]
    return int(np.searchsorted(np.cumsum(held), RECALL * held.sum())) + 1


def probe(queries: DataFrame, centres: np.ndarray, sizes: np.ndarray, k: int, least: int) -> DataFrame:
    """The nearest lists of each query, at least ``least`` of them and enough to hold ten times k vectors."""
    shared = queries.sparkSession.sparkContext.broadcast((centres, sizes))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, n = shared.value
        for pdf in parts:
            if len(pdf):
                q = lifted_queries(stacked(pdf["vector"]))
                order = ((c**2).sum(axis=1) - 2 * q @ c.T).argsort(axis=1)
                out = []
                for cid, vector, near in zip(pdf["cid"], pdf["vector"], order, strict=True):
                    most = max(least, int(np.searchsorted(np.cumsum(n[near]), 10 * k)) + 1)
                    out += [(cid, vector, int(at), place) for place, at in enumerate(near[:most])]
                yield pd.DataFrame(out, columns=["qcid", "vector", "list", "place"])

    return queries.select("cid", "vector").mapInPandas(run, "qcid long, vector array<float>, list int, place int")


def scan(probes: DataFrame, index: DataFrame, longest: float, k: int) -> DataFrame:
    """Candidates of each query (``reach``: the squared distance that counts; NULL: all) in its lists' blocks."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "list": [int(pdf["list"].iloc[0])], "qcids": [pdf["qcid"].to_numpy(np.int64).tobytes()],
            "queries": [stacked(pdf["vector"]).astype(np.float32).tobytes()],
            "reaches": [pdf["reach"].fillna(np.inf).to_numpy(np.float64).tobytes()],
        })

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                cids, firsts = np.frombuffer(row.cids, np.int64), np.frombuffer(row.firsts, np.int64)
                x = np.frombuffer(row.vectors, np.float32).reshape(len(cids), -1).astype(np.float64)
                turned = np.frombuffer(row.columns, np.float32).reshape(-1, len(cids)).T.astype(np.float64, order="C")
                qcids, reaches = np.frombuffer(row.qcids, np.int64), np.frombuffer(row.reaches, np.float64)
                q = np.frombuffer(row.queries, np.float32).reshape(len(qcids), -1).astype(np.float64)
                at, rows = abandon(turned, lifted_queries(q), reaches)
                scores = (x[rows] * q[at]).sum(axis=1)
                order = np.lexsort((firsts[rows], -scores, at))
                at, rows, scores = at[order], rows[order], scores[order]
                best = np.arange(len(at)) - np.searchsorted(at, at) <= k  # places of a query among its own
                at, rows, scores = at[best], rows[best], scores[best]
                if len(at):
                    yield pd.DataFrame({"qcid": qcids[at], "cid": cids[rows], "first": firsts[rows], "score": scores})

    counts = write_out(probes, "probes").withColumn(ROW, F.xxhash64("qcid", "list"))
    blocks = ranked(counts, "list", "_at").withColumn("qblock", F.floor(F.col("_at") / QUERY_BLOCK))
    packed = blocks.groupBy("list", "qblock").applyInPandas(pack, "list int, qcids binary, queries binary, reaches binary")
    return packed.join(index, "list").mapInPandas(run, FOUND)


def nearest(df: DataFrame, k: int, is_query, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products found for each query row, itself left out.

    ``is_query`` is a condition on ``vec_id``. Scores are exact, in double precision, on the original vectors; ties
    go to the smaller id. Vectors that are NULL, zero, of another dimension than the usual one or hold NULL or
    non-finite numbers take no part; rows that repeat an id and vector count once. Equal vectors share one place in
    the index and one search. A table without usable vectors gives no rows.

    The nearest list of each query is scanned whole. Its k-th distance is the reach with which the next lists are
    scanned adaptively, and theirs is the reach for all others. How many lists are probed is measured on the table
    itself, see ``probes_needed``.
    """
    spark = prepare(df.sparkSession)
    rows = write_out(usable(df, vector, key), "usable")
    classes = vector_classes(rows, k)
    lengths = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    stats = classes.agg(F.count("*").alias("n"), F.max(lengths).alias("longest")).first()
    if not stats.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(stats.longest)
    lists = max(1, min(MOST_LISTS, int(stats.n**0.5)))
    picked = classes.orderBy(F.xxhash64("vector")).select("vector").limit(SAMPLE).toPandas()["vector"]
    centres = centres_of(lifted(stacked(picked), longest), lists)
    index = build_index(classes, centres, longest)
    sizes = np.zeros(lists, np.int64)
    for row in index.groupBy("list").agg(F.sum(F.length("cids") / 8).alias("n")).collect():
        sizes[row.list] = int(row.n)
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = write_out(asked.join(classes.select("cid", "vector"), "vector").select("query_id", "cid"), "asked")
    queries = classes.join(asked.select("cid").distinct(), "cid", "left_semi")
    least = max(PROBES, probes_needed(queries, index, centres, k))
    probes = write_out(probe(queries, centres, sizes, k, least), "all-probes")
    place = F.row_number().over(Window.partitionBy("qcid").orderBy(F.desc("score"), "first"))
    length2 = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    best = spark.createDataFrame([], FOUND)
    for first, last in zip((0, *ROUNDS), (*ROUNDS, lists), strict=True):
        kth = best.withColumn("_n", place).where(F.col("_n") == k + 1).select("qcid", F.col("score").alias("kth"))
        # While a query has k vectors or fewer, it has no reach; greatest() alone would make it 0.
        reach = F.when(F.col("kth").isNotNull(), F.greatest(longest**2 + length2 - 2 * F.col("kth"), F.lit(0.0)))
        due = probes.where((F.col("place") >= first) & (F.col("place") < last)).join(kth, "qcid", "left")
        found = best.union(scan(due.withColumn("reach", reach).drop("kth"), index, longest, k))
        best = write_out(found.withColumn("_n", place).where(F.col("_n") <= k + 1).drop("_n"), "best")
    best = best.drop("first")
    ids = best.join(classes.select("cid", "ids"), "cid").select("qcid", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("qcid").orderBy(F.desc("score"), "vec_id")
    ids = write_out(ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n"), "nearest")
    answers = asked.join(ids, asked.cid == ids.qcid).where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

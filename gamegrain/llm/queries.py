"""One query for each operator, over its whole table and with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamegrain.llm import (
    alignment, bytebpe, exact, html, katz, near, packing, quality, runs, sharding, simhash, tokencount, vectors,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(table(spark, folder, "embeddings"), 20, F.pmod("vec_id", F.lit(20)) == 0)


def op2_trie_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_pages(table(spark, folder, "pages"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"))


def op5_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, folder, "documents"), path)


def op6_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score_documents(table(spark, folder, "documents"))


def op7_lpt_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.encode_documents(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op9_kneser_ney_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_classes(table(spark, folder, "documents"))


def op11_segment_popcounts(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents"))


def op12_square_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.periodic_runs(table(spark, folder, "documents"))


def op13_fragment_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(table(spark, folder, "documents"), *paths)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_adaptive_scan, op2_trie_token_counts, op3_tree_scoring, op4_exact_dedup, op5_best_two_fit, op6_katz_backoff,
        op7_lpt_sharding, op8_byte_bpe, op9_kneser_ney_quality, op10_order_minhash, op11_segment_popcounts, op12_square_runs,
        op13_fragment_alignment,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
        FROM d
    """,
}

"""Corpus pipeline: quality, exact copies, near copies, packing; each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamegrain.llm import exact, near, packing, quality
from gamegrain.llm.common import write_out

# The row as it came, under one name, so that none of its columns clashes with those of an operator.
WHOLE = "_document"


def _row():
    return F.struct("*").alias(WHOLE)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier keeps, with their columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, labels, _row()).select(f"{WHOLE}.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact.exact_classes(docs, exact.older_half(), _row()).where("kept").select(f"{WHOLE}.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near.near_classes(docs, whole=True).where("kept").select("document.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

# Perplexities, alignments and packing cannot be said in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

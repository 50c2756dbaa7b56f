"""JSON documents whose fields change their type: kept as VARIANT, read by the type that is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BODY = "body"


def parse_drifting(lines: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the document as VARIANT ``body``, rows whose text is no JSON, as they came). No row is lost: NULL
    texts are no documents and go to the side."""
    parsed = lines.withColumn(BODY, F.try_parse_json(F.col(text)))
    return parsed.where(F.col(BODY).isNotNull()).drop(text), lines.where(F.try_parse_json(F.col(text)).isNull())


def field(path: str, kind: str, body: str = BODY) -> Column:
    """Value at a JSON path in the type, NULL where the document has another shape there."""
    return F.try_variant_get(F.col(body), path, kind)


def as_text(path: str, body: str = BODY) -> Column:
    """Whatever stands at the path as text: a text as it is, numbers written out, nested values as JSON."""
    return F.coalesce(F.try_variant_get(F.col(body), path, "string"), F.to_json(F.try_variant_get(F.col(body), path, "variant")))


def field_types(documents: DataFrame, body: str = BODY) -> DataFrame:
    """``field, type, documents``: the types that each field of the outermost objects has, and how often."""
    fields = documents.select(body).lateralJoin(documents.sparkSession.tvf.variant_explode(F.col(body).outer()))
    typed = fields.select(F.col("key").alias("field"), F.schema_of_variant(F.col("value")).alias("type"))
    return typed.groupBy("field", "type").agg(F.count("*").alias("documents"))


def drifted(documents: DataFrame, body: str = BODY) -> DataFrame:
    """Fields with more than one type, NULLs left aside."""
    types = field_types(documents, body).where("type <> 'VOID'")
    return types.groupBy("field").agg(F.count("*").alias("types"), F.sum("documents").alias("documents")).where("types > 1")


def common_schema(documents: DataFrame, body: str = BODY) -> DataFrame:
    """The schema that all documents have in common, as a one-row frame; drifting fields are VARIANT there."""
    return documents.agg(F.schema_of_variant_agg(F.col(body)).alias("schema"))

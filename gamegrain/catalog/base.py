"""Registry of the queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gamegrain.session import tune
from gamegrain.sources.readers import read_parquet
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

# Schemas of the tables; given to the reader, so that no scan starts with a look at the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The tables of one folder as attributes: ``Source(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", StructType.fromDDL(schema or TABLES[name]))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.read(name)


def query(sql: str | None = None):
    """Register a query under the name of its function, with the SQL that gives the same rows."""

    def register(function: Callable[[Source], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Source(tune(spark), folder))

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register

"""Scans, file inventories, landed JSON, inline lookups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamegrain.catalog.base import Source, query
from gamegrain.functions.nested import nest_schema
from gamegrain.functions.text import FOLDER_VALUE, path_key
from gamegrain.operators.joins import join_lookup
from gamegrain.operators.keys import key_set
from gamegrain.session import scratch_path
from gamegrain.sinks.documents import overwrite_partitions
from gamegrain.sources.inventory import file_inventory, folder_keys, latest_snapshot, newest_file, wanted_files
from gamegrain.sources.lookups import membership
from gamegrain.sources.readers import FILE_PATH, flatten, only_keyed, read_parquet


@query("""
    SELECT p_partkey, p_name, p_size, '(none)' AS p_comment FROM part
""")
def scan_explicit_schema(t: Source) -> DataFrame:
    """A declared column that the file lacks comes back NULL; undeclared ones are not read."""
    parts = t.read("part", "p_partkey bigint, p_name string, p_size int, p_comment string")
    return parts.fillna({"p_comment": "(none)"})


@query("""
    SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def scan_key_driven(t: Source) -> DataFrame:
    keys = key_set(t.orders, "o_orderkey", where="o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "l_orderkey")
    return only_keyed(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag"), keys, "l_orderkey")


def _events_by_day(t: Source) -> DataFrame:
    """Events stored in one folder per day."""
    path = scratch_path(t.spark, "events-by-day")
    overwrite_partitions(t.events.withColumn("day", F.to_date("ts")), path, "day")
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double, day date")
    return read_parquet(t.spark, path, schema)


@query("""
    SELECT event_id, user_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
    WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE value > 300)
""")
def scan_pruned_partitions(t: Source) -> DataFrame:
    """The wanted days are a frame: partitions are pruned at run time."""
    days = key_set(t.events.withColumn("day", F.to_date("ts")), "day", where="value > 300")
    return only_keyed(_events_by_day(t), days, "day").select(
        "event_id", "user_id", "value", F.col("day").cast("string").alias("day")
    )


@query("""
    SELECT c_custkey, c_mktsegment, sector, tier
    FROM customer
    JOIN (VALUES ('industry', 'MACHINERY'), ('industry', 'BUILDING'),
                 ('consumer', 'HOUSEHOLD'), ('consumer', 'FURNITURE')) AS s(sector, c_mktsegment) USING (c_mktsegment)
    JOIN (VALUES ('first', 'MACHINERY'), ('second', 'BUILDING'),
                 ('first', 'HOUSEHOLD'), ('second', 'AUTOMOBILE')) AS r(tier, c_mktsegment) USING (c_mktsegment)
""")
def inline_lookup_join(t: Source) -> DataFrame:
    sectors = membership(
        t.spark, {"industry": ("MACHINERY", "BUILDING"), "consumer": ("HOUSEHOLD", "FURNITURE")},
        "sector", "c_mktsegment",
    )
    tiers = membership(
        t.spark, {"first": ("MACHINERY", "HOUSEHOLD"), "second": ("BUILDING", "AUTOMOBILE")}, "tier", "c_mktsegment"
    )
    customers = t.customer.select("c_custkey", "c_mktsegment")
    joined = join_lookup(join_lookup(customers, sectors, "c_mktsegment"), tiers, "c_mktsegment")
    return joined.select("c_custkey", "c_mktsegment", "sector", "tier")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def loaded_key_probe(t: Source) -> DataFrame:
    return key_set(t.orders, "o_custkey", where="o_orderstatus = 'F'")


def _orders_by_year(t: Source, path: str, where: str = "true") -> str:
    orders = t.orders.withColumn("order_year", F.year("o_orderdate")).where(where)
    overwrite_partitions(orders, path, "order_year")
    return path


@query("SELECT DISTINCT 'order_year=' || year(o_orderdate) AS folder FROM orders")
def stored_folder_keys(t: Source) -> DataFrame:
    path = _orders_by_year(t, scratch_path(t.spark, "orders-by-year"))
    return folder_keys(file_inventory(t.spark, path), path)


@query("""
    SELECT DISTINCT 'order_year=' || year(o_orderdate) AS folder FROM orders
    WHERE year(o_orderdate) IN (SELECT year(l_shipdate) FROM lineitem WHERE l_returnflag = 'R')
""")
def file_membership(t: Source) -> DataFrame:
    """Which of the wanted folders are in storage."""
    path = _orders_by_year(t, scratch_path(t.spark, "orders-by-year"))
    years = key_set(t.lineitem.withColumn("year", F.year("l_shipdate")), "year", where="l_returnflag = 'R'")
    wanted = years.select(F.concat(F.lit("order_year="), F.col("year").cast("string")).alias("folder"))
    stored = folder_keys(file_inventory(t.spark, path), path).withColumnRenamed("folder", "name")
    return wanted_files(stored, wanted, "folder").withColumnRenamed("name", "folder")


@query("""
    SELECT CAST(max(year(o_orderdate)) AS VARCHAR) AS newest_year, true AS has_time FROM orders
""")
def newest_stored_file(t: Source) -> DataFrame:
    """The last year is written after the others, so one of its files is the newest."""
    path = scratch_path(t.spark, "orders-by-year")
    last = t.orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    _orders_by_year(t, path, f"order_year < {last}")
    _orders_by_year(t, path, f"order_year = {last}")
    return newest_file(file_inventory(t.spark, path)).select(
        path_key(F.col("path"), FOLDER_VALUE).alias("newest_year"), F.col("modified_at").isNotNull().alias("has_time")
    )


@query("""
    SELECT event_id, user_id, event_type FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def latest_snapshot_rows(t: Source) -> DataFrame:
    return latest_snapshot(t.events.withColumn("day", F.to_date("ts")), "day").select(
        "event_id", "user_id", "event_type"
    )


@query("""
    SELECT conv_id, turn, role, md5(text) AS text_md5,
           CASE WHEN turn = 0 THEN '0' ELSE 'turn ' || turn END AS mixed
    FROM conversations
""")
def json_flatten(t: Source) -> DataFrame:
    """Documents as JSON text files → flat rows; ``mixed`` is a number in some documents and text in others."""
    path = scratch_path(t.spark, "conversation-json")
    mixed = F.when(F.col("turn") == 0, F.lit("0")).otherwise(F.concat(F.lit('"turn '), F.col("turn"), F.lit('"')))
    body = F.to_json(F.struct("conv_id", F.struct("role", "turn", "text").alias("message")))
    opened = F.substring(body, F.lit(1), F.char_length(body) - 1)
    t.conversations.select(F.concat(opened, F.lit(',"mixed":'), mixed, F.lit("}"))).write.text(path)
    flat = T.StructType.fromDDL(
        "conv_id bigint, `message.role` string, `message.turn` bigint, `message.text` string, mixed string"
    )
    documents = flatten(t.spark.read.schema(nest_schema(flat)).json(path))
    return documents.select(
        "conv_id", F.col("`message.turn`").alias("turn"), F.col("`message.role`").alias("role"),
        F.md5("`message.text`").alias("text_md5"), "mixed",
    )


@query("SELECT doc_id, lang AS path_lang FROM documents")
def file_provenance_key(t: Source) -> DataFrame:
    """The language is in the path of the file only."""
    path = scratch_path(t.spark, "documents-by-lang")
    overwrite_partitions(t.documents.select("doc_id", "lang"), path, "lang")
    stored = t.spark.read.schema("doc_id bigint").parquet(path)
    return stored.select("doc_id", path_key(F.col(FILE_PATH), FOLDER_VALUE).alias("path_lang"))

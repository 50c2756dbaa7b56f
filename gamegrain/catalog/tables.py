"""Table maintenance and sinks, each read back after the write."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source, query
from gamegrain.operators.versions import latest_by
from gamegrain.session import scratch_path
from gamegrain.sinks.contracts import TIME, Kind, TableSpec, split_by_contract
from gamegrain.sinks.documents import overwrite_partitions, put_documents
from gamegrain.sinks.tables import Table

NUMBER, WHOLE, KEY, TEXT = Kind("double"), Kind("int", 0, 2**31 - 1), Kind("bigint", 0, 2**63 - 1), Kind("string")
ORDERS = TableSpec(
    "orders", {"o_orderkey": KEY, "o_custkey": KEY, "o_orderstatus": TEXT, "o_totalprice": NUMBER}, ("o_orderkey",)
)
CUSTOMERS = TableSpec(
    "customers", {"c_custkey": KEY, "c_name": TEXT, "c_nationkey": WHOLE, "c_acctbal": NUMBER},
    ("c_nationkey", "c_custkey"),
)
USER_STATE = TableSpec(
    "user_state", {"user_id": KEY, "event_id": KEY, "event_type": TEXT, "value": NUMBER, "ts": TIME}, ("user_id",),
    version="ts",
)


def _table(t: Source, spec: TableSpec, *spread_by: str) -> Table:
    return Table(t.spark, scratch_path(t.spark, spec.name), spec, spread_by)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def append_new_facts(t: Source) -> DataFrame:
    """The second load brings all rows; those of the first are not stored twice."""
    table = _table(t, ORDERS)
    table.append_new(t.orders.where("o_orderstatus = 'F'"))
    table.append_new(t.orders)
    return table.read()


@query("""
    SELECT o_orderkey, year(o_orderdate) AS order_year,
           CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice ELSE 0.0 END AS price
    FROM orders
""")
def partition_overwrite(t: Source) -> DataFrame:
    """Partitions without new rows keep what they have."""
    path = scratch_path(t.spark, "orders-by-year")
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"), "o_totalprice")
    first = orders.select("o_orderkey", "order_year", F.lit(0.0).alias("price"))
    overwrite_partitions(first, path, "order_year")
    overwrite_partitions(
        orders.where("order_year >= 1998").withColumnRenamed("o_totalprice", "price"), path, "order_year"
    )
    stored = t.spark.read.schema("o_orderkey bigint, price double, order_year int").parquet(path)
    return stored.select("o_orderkey", "order_year", "price")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'open' END AS state FROM orders
""")
def document_put(t: Source) -> DataFrame:
    """Documents are replaced by key within the blocks they fall into."""
    path = scratch_path(t.spark, "order-documents")
    put_documents(t.orders.select("o_orderkey", F.lit("open").alias("state")), path, "o_orderkey")
    finished = t.orders.where("o_orderstatus = 'F'")
    put_documents(finished.select("o_orderkey", F.col("o_orderpriority").alias("state")), path, "o_orderkey")
    return t.spark.read.schema("o_orderkey bigint, state string").parquet(path).select("o_orderkey", "state")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def staged_replace(t: Source) -> DataFrame:
    """A second snapshot takes the place of the first; rows of a nation lie together, sorted by key."""
    table = _table(t, CUSTOMERS, "c_nationkey")
    table.replace(t.customer.withColumn("c_acctbal", F.lit(0.0)))
    table.replace(t.customer)
    return table.read()


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert_compact(t: Source) -> DataFrame:
    """Two appends of versions, then a compaction, run twice."""
    table = _table(t, USER_STATE)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    table.append(t.events.where(early))
    table.append(t.events.where(~early))
    table.compact()
    table.compact()
    return table.read().drop("ts")


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_version(t: Source) -> DataFrame:
    events = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return latest_by(events, ["user_id"], "ts", ["event_id"]).drop("ts")


@query("""
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('month', ts) DESC, value DESC,
                               event_id DESC) = 1
""")
def latest_version_ties(t: Source) -> DataFrame:
    """Most versions are equal; the tie columns decide."""
    events = t.events.select(
        "user_id", "event_type", "event_id", "value", F.date_trunc("month", "ts").alias("version")
    )
    return latest_by(events, ["user_id", "event_type"], "version", ["value", "event_id"]).drop("version")


@query("""
    SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS quantity, l_shipdate IS NOT NULL AS has_date,
           l_quantity <= 40 AS taken
    FROM lineitem
""")
def contract_split(t: Source) -> DataFrame:
    """Rows that break a range go to the side, nothing is lost."""
    spec = TableSpec("lines", {"l_orderkey": KEY, "l_quantity": Kind("smallint", 0, 40), "l_shipdate": TIME},
                     ("l_orderkey",))
    taken, refused = split_by_contract(t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate"), spec)
    rows = taken.withColumn("taken", F.lit(True)).unionByName(refused.withColumn("taken", F.lit(False)))
    return rows.select(
        "l_orderkey", F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_shipdate").isNotNull().alias("has_date"), "taken",
    )

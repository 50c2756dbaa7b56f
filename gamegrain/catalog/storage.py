"""Streams of new files, loads that are stored once, and reads that skip what they do not need."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamegrain.catalog.base import Source, query
from gamegrain.catalog.tables import CUSTOMERS, ORDERS, USER_STATE
from gamegrain.operators.gates import GateError
from gamegrain.operators.keys import key_set
from gamegrain.operators.observed import Gate
from gamegrain.operators.pivots import pivot_map
from gamegrain.operators.versions import latest_by
from gamegrain.session import scratch_path
from gamegrain.sinks import keycounts
from gamegrain.sinks.batches import insert_once, stored_batches
from gamegrain.sinks.bucketed import write_bucketed
from gamegrain.sinks.documents import overwrite_partitions, put_documents
from gamegrain.sinks.tables import Table
from gamegrain.sinks.versioned import VersionedTable
from gamegrain.sources import drift
from gamegrain.sources.keyed import keyed_scan
from gamegrain.sources.listing import listed_files, newest_snapshot, stored_folders
from gamegrain.streaming.arrivals import follow_into

STATUSES = ("F", "O", "P")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def streamed_deliveries(t: Source) -> DataFrame:
    """Three deliveries of files; the stream is started anew for each, and once more when nothing has come."""
    path, log = (scratch_path(t.spark, name) for name in ("orders-delivered", "orders-log"))
    table = Table(t.spark, scratch_path(t.spark, "orders"), ORDERS)
    for status in (*STATUSES, None):
        if status is not None:
            t.orders.where(F.col("o_orderstatus") == status).write.mode("append").parquet(path)
        follow_into(table, path, t.orders.schema, log)
    return table.read()


@query("""
    SELECT l_orderkey, count(*) AS n_lines, string_agg(l_linenumber, ',' ORDER BY l_linenumber, l_partkey) AS numbers,
           sum(CAST(l_quantity AS BIGINT)) AS quantity
    FROM lineitem GROUP BY 1
""")
def append_batches(t: Source) -> DataFrame:
    """Orders with their lines as an array, sent in batches; one load comes twice and is stored once."""
    path = scratch_path(t.spark, "line-batches")
    line = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    even = F.col("l_orderkey") % 2 == 0
    insert_once(rows.where(even), path, "even")
    insert_once(rows.where(~even), path, "odd")
    insert_once(rows.where(even), path, "even")
    stored = stored_batches(t.spark, path, rows.schema)
    total = F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"].cast("bigint"))
    return stored.select(
        "l_orderkey", F.size("lines").cast("bigint").alias("n_lines"),
        F.array_join(F.transform("lines", lambda x: x["number"].cast("string")), ",").alias("numbers"), total.alias("quantity"),
    )


@query("SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' AND o_custkey > 40 GROUP BY 1")
def pushed_key_probe(t: Source) -> DataFrame:
    """Loaded keys of a target that takes the predicate: only rows it leaves come to Spark."""
    path = scratch_path(t.spark, "order-target")
    insert_once(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, "orders")
    stored = stored_batches(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    wanted = stored.where("o_orderstatus = 'F' AND o_custkey > 40")
    return wanted.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_partkey % 10 = 0)
""")
def keyed_block_scan(t: Source) -> DataFrame:
    """Documents of wanted keys, from the blocks of storage that hold them."""
    path, size = scratch_path(t.spark, "order-blocks"), 500
    documents = t.orders.select("o_orderkey", "o_orderpriority")
    put_documents(documents, path, "o_orderkey", block_keys=size)
    keys = key_set(t.lineitem, "l_orderkey", where="l_quantity = 50 AND l_partkey % 10 = 0")
    stored = t.spark.read.schema(documents.schema.add("block", "long")).parquet(path)
    return keyed_scan(stored, keys.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", size).drop("block")


@query("""
    WITH l AS (SELECT l_orderkey AS k, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q,
                      count(DISTINCT l_linestatus) AS sides FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS order_key, o_orderstatus AS status, n, q, sides FROM orders JOIN l ON o_orderkey = k
""")
def bucketed_reassembly(t: Source) -> DataFrame:
    """Orders and lines stored in buckets of one key: aggregation and join without a shuffle."""
    return reassembled(*bucketed_orders(t))


def bucketed_orders(t: Source) -> tuple[DataFrame, DataFrame]:
    """Orders and lines by order key, in equal buckets."""
    name, count = uuid.uuid4().hex, 16
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_quantity", "l_linestatus")
    return (
        write_bucketed(orders, f"orders_{name}", "order_key", scratch_path(t.spark, "bucketed-orders"), count),
        write_bucketed(lines, f"lines_{name}", "order_key", scratch_path(t.spark, "bucketed-lines"), count, ("l_linenumber",)),
    )


def reassembled(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines counted by order and joined with their order."""
    sides = [F.max(F.when(F.col("l_linestatus") == s, 1).otherwise(0)) for s in ("F", "O")]
    counted = lines.groupBy("order_key").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        (sides[0] + sides[1]).cast("bigint").alias("sides"))
    return orders.hint("merge").join(counted, "order_key")


@query("""
    SELECT order_key, n AS line_number, q AS quantity
    FROM (SELECT l_orderkey AS order_key, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS q,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC) AS r FROM lineitem)
    WHERE r = 1
""")
def bucketed_latest(t: Source) -> DataFrame:
    """The newest version of every key of a table in buckets: no shuffle either."""
    _, lines = bucketed_orders(t)
    newest = latest_by(lines.select("order_key", "l_linenumber", "l_quantity"), ["order_key"], "l_linenumber", ["l_quantity"])
    return newest.select("order_key", F.col("l_linenumber").alias("line_number"), F.col("l_quantity").cast("bigint").alias("quantity"))


@query("""
    SELECT conv_id, turn, turn % 7 <> 3 AS parsed,
           CASE WHEN turn % 7 = 3 THEN NULL WHEN turn % 2 = 0 THEN CAST(turn AS VARCHAR) ELSE 'turn ' || turn END AS label,
           CASE WHEN turn % 7 <> 3 AND turn % 2 = 0 THEN turn END AS number,
           CASE WHEN turn % 7 <> 3 AND turn % 2 = 1 THEN '[' || turn || ',"x"]' END AS listed
    FROM conversations
""")
def drifting_documents(t: Source) -> DataFrame:
    """A field that is a number in some documents and text in others, a list in some only, and documents cut short."""
    taken, broken = drift.parse_drifting(_drifting(t), "line")
    rows = taken.select(
        "conv_id", "turn", F.lit(True).alias("parsed"), drift.as_text("$.label").alias("label"),
        drift.field("$.label", "bigint").alias("number"), drift.as_text("$.listed").alias("listed"))
    none = F.lit(None)
    return rows.unionByName(broken.select(
        "conv_id", "turn", F.lit(False).alias("parsed"), none.cast("string").alias("label"),
        none.cast("bigint").alias("number"), none.cast("string").alias("listed")))


def _drifting(t: Source) -> DataFrame:
    turn = F.col("turn").cast("string")
    odd = F.concat(F.lit('{"label": "turn '), turn, F.lit('", "listed": ['), turn, F.lit(', "x"]}'))
    line = F.when(F.col("turn") % 7 == 3, F.lit('{"label": "cut')).when(
        F.col("turn") % 2 == 0, F.concat(F.lit('{"label": '), turn, F.lit("}"))).otherwise(odd)
    return t.conversations.select("conv_id", "turn", line.alias("line"))


@query("""
    SELECT field, type, count(*) AS documents
    FROM (SELECT 'label' AS field, CASE WHEN turn % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END AS type
          FROM conversations WHERE turn % 7 <> 3
          UNION ALL SELECT 'listed', 'ARRAY<VARIANT>' FROM conversations WHERE turn % 7 <> 3 AND turn % 2 = 1)
    GROUP BY ALL
""")
def drift_report(t: Source) -> DataFrame:
    return drift.field_types(drift.parse_drifting(_drifting(t), "line")[0])


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, 2 AS refused FROM customer")
def gated_replace(t: Source) -> DataFrame:
    """Gates measured by the pass that stages the rows: a snapshot with a nation too few and an empty one do not
    take the place of the whole one."""
    table = Table(t.spark, scratch_path(t.spark, "customers"), CUSTOMERS, ("c_nationkey",))
    numbered = t.customer.withColumn("c_nation", F.col("c_nationkey") + 1)
    whole = Gate("c_nation", t.nation.count())
    table.replace(numbered, whole)
    refused = 0
    for part in (numbered.where("c_nationkey > 0"), numbered.where("false")):
        try:
            table.replace(part, whole)
        except GateError:
            refused += 1
    return table.read().withColumn("refused", F.lit(refused))


@query("SELECT DISTINCT 'order_year=' || year(o_orderdate) AS folder FROM orders")
def listed_folder_keys(t: Source) -> DataFrame:
    """Folders below a root, listed by one task each."""
    path = scratch_path(t.spark, "orders-by-year")
    overwrite_partitions(t.orders.withColumn("order_year", F.year("o_orderdate")), path, "order_year")
    return stored_folders(listed_files(t.spark, path))


@query("""
    SELECT event_id, user_id, event_type FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def newest_snapshot_rows(t: Source) -> DataFrame:
    """The newest day is told by the names of the folders; the other days are not read."""
    path = scratch_path(t.spark, "events-by-day")
    overwrite_partitions(t.events.withColumn("day", F.to_date("ts")), path, "day")
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, day date")
    return newest_snapshot(t.spark, path, schema, "day").drop("day")


@query("""
    SELECT 1 + n AS loads, count(DISTINCT o_custkey) AS customers
    FROM orders JOIN (VALUES (0), (1), (2)) v(n) ON o_orderkey % 3 <= n GROUP BY 1
""")
def merged_distinct_counts(t: Source) -> DataFrame:
    """Exact distinct customers after each of three loads, one of them stored twice; no load is read again."""
    path, found = scratch_path(t.spark, "customer-bitmaps"), None
    for n in range(3):
        part = t.orders.where(F.col("o_orderkey") % 3 == n)
        for _ in range(1 + n % 2):
            keycounts.store_keys(part, path, "o_custkey", f"load-{n}")
        so_far = keycounts.stored_keys(t.spark, path).where(F.col("load").isin([f"load-{i}" for i in range(n + 1)]))
        row = keycounts.distinct_keys(so_far, "customers").select(F.lit(n + 1).alias("loads"), "customers")
        found = row if found is None else found.unionByName(row)
    return found


@query("""
    SELECT user_id, count(*) AS n_categories, string_agg(event_type || ':' || first_id, ',' ORDER BY event_type) AS firsts
    FROM (SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_id FROM events
          WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY 1
""")
def map_pivot(t: Source) -> DataFrame:
    """Attribute rows as one map per user; no category is named anywhere."""
    maps = pivot_map(t.events, ["user_id"], "event_type", "event_id", ["ts", "event_id"])
    pairs = F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return maps.select("user_id", F.size("attributes").cast("bigint").alias("n_categories"), F.array_join(pairs, ",").alias("firsts"))


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def compact_changed_buckets(t: Source) -> DataFrame:
    """Versions of all users, then later ones of a few: the second compaction takes the buckets of those only."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "user-state"), USER_STATE, 32)
    late = (F.col("user_id") % 16 == 3) & (F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    for part in (t.events.where(~late), t.events.where(late)):
        table.append(part)
        table.compact()
    return table.read().drop("ts")

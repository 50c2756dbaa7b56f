"""Projections, joins, aggregates, key sets and gates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source, query
from gamegrain.functions.clocks import periods
from gamegrain.functions.nested import picks
from gamegrain.functions.points import rate_or_zero, result_points
from gamegrain.operators import gates
from gamegrain.operators.joins import coverage, join_dimension
from gamegrain.operators.keys import any_of, key_set, listed_ids, only, without
from gamegrain.operators.pivots import eav_pivot, pivot_join_back
from gamegrain.operators.sides import facing_rows, side_rows, side_totals, with_opponent
from gamegrain.streaming.increments import feed_completeness, new_keys, open_periods, open_rows

SIDES = ("F", "O")
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def ordered_topn(t: Source) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(100)


@query("SELECT c_custkey AS player_id, c_name AS first_name, c_mktsegment AS segment FROM customer")
def rename_dotted(t: Source) -> DataFrame:
    """Literal dotted names; a name that is not there is ignored."""
    dotted = t.customer.select(
        F.col("c_custkey").alias("player.id"), F.col("c_name").alias("firstName.default"),
        F.col("c_mktsegment").alias("segment"),
    )
    return dotted.withColumnsRenamed({"player.id": "player_id", "firstName.default": "first_name", "no.such": "x"})


@query("SELECT o_orderkey, o_custkey AS customer, o_orderpriority AS priority, o_totalprice FROM orders")
def nested_field_access(t: Source) -> DataFrame:
    who = F.struct(F.struct(F.col("o_custkey").alias("id")).alias("customer"), F.col("o_orderpriority").alias("level"))
    nested = t.orders.select(F.struct("o_orderkey", who.alias("who"), "o_totalprice").alias("game"))
    return nested.select(
        *picks(F.col("game"), ["o_orderkey", ("who.customer.id", "customer"), ("who.level", "priority"),
                               "o_totalprice"])
    )


@query("""
    SELECT l_orderkey, 'line' AS kind, CAST(l_quantity AS BIGINT) AS quantity,
           round(l_extendedprice * (1 - l_discount), 4) AS net_price,
           CASE WHEN l_quantity > 25 THEN 2 WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS grade
    FROM lineitem
""")
def derived_columns(t: Source) -> DataFrame:
    grade = F.when(F.col("l_quantity") > 25, 2).when(F.col("l_discount") > 0.05, 1).otherwise(0)
    rows = t.lineitem.withColumns(
        {
            "kind": F.lit("line"),
            "quantity": F.col("l_quantity").cast("bigint"),
            "net_price": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
            "grade": grade,
        }
    )
    return rows.select("l_orderkey", "kind", "quantity", "net_price", "grade")


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""")
def enum_and_exclusion(t: Source) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.col("o_orderkey").alias("key"), "o_orderpriority"
    )
    lines = t.lineitem.withColumnRenamed("l_orderkey", "key")
    return open_rows(urgent, lines, "key", "l_returnflag = 'R'").withColumnRenamed("key", "o_orderkey")


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def key_membership(t: Source) -> DataFrame:
    keys = key_set(t.customer, "c_custkey", where="c_mktsegment = 'BUILDING'")
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return only(orders, keys, "c_custkey").select("o_orderkey", "o_orderstatus")


def _side_totals(t: Source) -> DataFrame:
    metrics = {
        "qty": F.col("l_quantity"),
        "returned": F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0),
    }
    return side_totals(t.lineitem, "l_orderkey", "l_linestatus", metrics, SIDES)


_SIDE_SQL = """
    WITH s AS (
        SELECT l_orderkey, l_linestatus AS side, count(*) AS n, sum(l_quantity) AS qty,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned
        FROM lineitem GROUP BY ALL
    )
"""


@query(_SIDE_SQL + """
    SELECT a.l_orderkey, a.side, a.qty, a.returned, b.qty AS opp_qty, b.returned AS opp_returned,
           b.qty - b.returned AS kept,
           CASE WHEN b.qty = 0 THEN 0 ELSE round((b.qty - b.returned) / b.qty, 4) END AS kept_rate
    FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.side <> b.side
""")
def opponent_stats(t: Source) -> DataFrame:
    """Each side of an order sees the other's figures: one aggregation, no self-join."""
    rows = facing_rows(_side_totals(t), "l_orderkey", ["qty", "returned"], SIDES, "side")
    rate = (F.col("opp_qty") - F.col("opp_returned")).alias("kept")
    return rows.select(
        "*", rate, F.round(F.when(F.col("opp_qty") == 0, 0).otherwise(F.col("kept") / F.col("opp_qty")), 4)
        .alias("kept_rate"),
    )


@query(_SIDE_SQL + """
    SELECT a.l_orderkey, a.side, a.n, a.qty, b.n AS opp_n, b.qty AS opp_qty
    FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.side <> b.side
""")
def opponent_self_join(t: Source) -> DataFrame:
    """The same for rows that are there per side already."""
    sides = t.lineitem.groupBy("l_orderkey", F.col("l_linestatus").alias("side")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty")
    )
    return with_opponent(sides, "l_orderkey", "side", ["n", "qty"], SIDES)


@query(_SIDE_SQL + """
    SELECT a.l_orderkey, a.side,
           CASE WHEN a.qty > b.qty THEN 2
                WHEN (CASE WHEN f.n = o.n THEN 'OT' WHEN f.n > o.n THEN 'REG' END) <> 'REG' THEN 1
                ELSE 0 END AS points
    FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.side <> b.side
    JOIN s f ON f.l_orderkey = a.l_orderkey AND f.side = 'F'
    JOIN s o ON o.l_orderkey = a.l_orderkey AND o.side = 'O'
""")
def result_points_rule(t: Source) -> DataFrame:
    """Winner 2, loser 1 unless decided in regulation; an unknown period type (NULL) gives the loser 0."""
    totals = _side_totals(t).where("F_rows > 0 AND O_rows > 0")
    period = F.when(F.col("F_rows") == F.col("O_rows"), "OT").when(F.col("F_rows") > F.col("O_rows"), "REG")
    games = totals.withColumn("period_type", period)
    sides = {
        own: {"points": result_points(F.col(f"{own}_qty"), F.col(f"{other}_qty"), F.col("period_type"))}
        for own, other in (SIDES, SIDES[::-1])
    }
    return side_rows(games, ["l_orderkey"], sides, "side")


@query("""
    WITH s AS (SELECT l_orderkey, sum(l_quantity) AS whole,
                      sum(CASE WHEN l_returnflag = 'A' THEN l_quantity - l_linenumber ELSE 0 END) AS part
               FROM lineitem GROUP BY 1)
    SELECT l_orderkey, round(CAST(CAST(CASE WHEN whole = 0 THEN 0 ELSE part / whole END AS FLOAT) AS DOUBLE), 4) AS rate
    FROM s
""")
def guarded_rate(t: Source) -> DataFrame:
    totals = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("whole"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity") - F.col("l_linenumber")).otherwise(0))
        .alias("part"),
    )
    rate = rate_or_zero(F.col("part"), F.col("whole"))
    return totals.select("l_orderkey", F.round(rate.cast("double"), 4).alias("rate"))


@query("""
    SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def dim_broadcast_join(t: Source) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return join_dimension(t.customer, nations, ["c_nationkey"]).select("c_custkey", "c_name", "n_name")


@query("""
    SELECT o_orderkey, o_orderstatus, n_lines, qty, top_price
    FROM orders
    JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) a
      ON a.l_orderkey = o_orderkey
    JOIN (SELECT l_orderkey, max(l_extendedprice) AS top_price FROM lineitem GROUP BY 1) b
      ON b.l_orderkey = o_orderkey
""")
def reassemble_join(t: Source) -> DataFrame:
    """Two branches of one source come back under the key: one aggregation carries both."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n_lines"), F.sum("l_quantity").alias("qty"), F.max("l_extendedprice").alias("top_price")
    )
    return t.orders.select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey")


_PIVOT_SQL = ", ".join(f"max(CASE WHEN event_type = '{name}' THEN value END) AS {name}" for name in EVENT_TYPES)
_FIRST_SQL = ", ".join(
    f"arg_min(value, (ts, event_id)) FILTER (WHERE event_type = '{name}') AS {name}" for name in EVENT_TYPES
)


@query(f"""
    SELECT user_id, {_FIRST_SQL}, coalesce(max(CASE WHEN event_type = 'no_such' THEN value END), -1) AS no_such
    FROM events GROUP BY user_id
""")
def eav_pivot_first(t: Source) -> DataFrame:
    """First value per cell; a listed category without rows is a NULL column."""
    wide = eav_pivot(t.events, ["user_id"], "event_type", "value", [*EVENT_TYPES, "no_such"], ["ts", "event_id"])
    return wide.fillna({"no_such": -1.0})


@query(f"""
    WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, {_PIVOT_SQL} FROM events
               WHERE event_type <> 'error' GROUP BY ALL),
         b AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT b.user_id, CAST(b.day AS VARCHAR) AS day, n, click, error, purchase, signup, view
    FROM b JOIN p USING (user_id, day)
""")
def pivot_join_back_rows(t: Source) -> DataFrame:
    """Composite key; keys that have no attribute row drop."""
    events = t.events.withColumn("day", F.to_date("ts").cast("string"))
    base = events.groupBy("user_id", "day").agg(F.count("*").alias("n"))
    return pivot_join_back(
        base, events.where("event_type <> 'error'"), ["user_id", "day"],
        category="event_type", value="value", categories=EVENT_TYPES,
    )


@query("""
    SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def new_keys_anti(t: Source) -> DataFrame:
    loaded = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return new_keys(t.orders, loaded, "o_orderkey")


@query("""
    WITH c AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
         o AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT coalesce(c_custkey, o_custkey) AS custkey,
           CASE WHEN c_custkey IS NULL THEN 'left' ELSE 'right' END AS missing_in
    FROM c FULL JOIN o ON c_custkey = o_custkey WHERE c_custkey IS NULL OR o_custkey IS NULL
""")
def lookup_coverage(t: Source) -> DataFrame:
    """Keys only one of two tables has; the gate holds the number of nations against the regions' table of them."""
    gates.expect_distinct(t.nation, "n_nationkey", t.nation.join(t.region, F.expr("n_regionkey = r_regionkey")).count())
    return coverage(
        t.customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("custkey")),
        t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("custkey")),
        "custkey",
    )


@query("""
    SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders,
           (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_pairs
    FROM lineitem
""")
def row_and_distinct_counts(t: Source) -> DataFrame:
    lines = t.lineitem
    return gates.summary(
        n_rows=lines, n_orders=key_set(lines, "l_orderkey"), n_pairs=key_set(lines, "l_orderkey", "l_linenumber")
    )


@query("SELECT count(DISTINCT l_partkey) AS parts FROM lineitem")
def exact_distinct_count(t: Source) -> DataFrame:
    return gates.distinct_count(t.lineitem, "l_partkey", name="parts")


@query("""
    SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey FROM lineitem UNION SELECT o_custkey FROM orders
""")
def collect_ids(t: Source) -> DataFrame:
    """Ids from two lists per row and from a second table, each id once."""
    lists = t.lineitem.select(F.array("l_partkey").alias("a"), F.array("l_suppkey").alias("b"))
    return any_of(listed_ids(lists, "a", "b"), key_set(t.orders.select(F.col("o_custkey").alias("id")), "id"))


@query("SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def key_difference(t: Source) -> DataFrame:
    keys = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return without(key_set(t.orders, "o_custkey"), keys, "o_custkey")


@query("""
    SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS games_loaded,
           (SELECT count(DISTINCT user_id) FROM events) AS players_updated
""")
def run_summary(t: Source) -> DataFrame:
    return gates.summary(
        games_loaded=t.orders.where("o_orderstatus = 'F'"), players_updated=key_set(t.events, "user_id")
    )


@query("""
    WITH p AS (
        SELECT CAST(s AS DATE) AS period_start, CAST(s AS DATE) + 6 AS period_end
        FROM generate_series((SELECT CAST(min(ts) AS DATE) FROM events)::TIMESTAMP,
                             (SELECT CAST(max(ts) AS DATE) FROM events)::TIMESTAMP, INTERVAL 7 DAY) AS g(s)
    )
    SELECT CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end,
           count(*) AS n, CAST(sum(CAST(value AS DECIMAL(20, 6))) AS DOUBLE) AS value
    FROM p JOIN events ON CAST(ts AS DATE) BETWEEN period_start AND period_end GROUP BY ALL
""")
def period_series(t: Source) -> DataFrame:
    """Weekly periods over the span of the table; a row finds its period by arithmetic, not by a range join."""
    first, last = t.events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    weeks = periods(t.spark, first, last)
    offset = F.datediff(F.to_date("ts"), F.lit(first))
    start = F.date_add(F.lit(first), (offset - offset % 7).cast("int"))
    per_week = t.events.groupBy(start.alias("period_start")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(20,6)")).cast("double").alias("value")
    )
    return weeks.join(per_week, "period_start").select(
        F.col("period_start").cast("string"), F.col("period_end").cast("string"), "n", "value"
    )


@query("""
    WITH p AS (
        SELECT CAST(s AS DATE) AS period_start, CAST(s AS DATE) + 6 AS period_end
        FROM generate_series((SELECT CAST(min(ts) AS DATE) FROM events)::TIMESTAMP,
                             (SELECT CAST(max(ts) AS DATE) FROM events)::TIMESTAMP, INTERVAL 7 DAY) AS g(s)
    )
    SELECT CAST(period_start AS VARCHAR) AS period_start FROM p
    WHERE NOT (period_start IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase')
               AND (SELECT CAST(max(ts) AS DATE) FROM events) - 1 > period_end)
""")
def open_period_list(t: Source) -> DataFrame:
    """Stored periods that ended before yesterday are closed; the others are fetched again."""
    first, last = t.events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    stored = t.events.where("event_type = 'purchase'").select(F.to_date("ts").alias("period_start"))
    return open_periods(periods(t.spark, first, last), stored, last).select(
        F.col("period_start").cast("string").alias("period_start")
    )


@query("""
    SELECT l_orderkey, coalesce(bool_or(l_returnflag = 'R'), false) AS "has_R",
           coalesce(bool_or(l_returnflag = 'A'), false) AS "has_A",
           coalesce(bool_or(l_returnflag = 'N'), false) AS "has_N", count(DISTINCT l_returnflag) = 3 AS complete
    FROM lineitem GROUP BY 1
""")
def feed_completeness_check(t: Source) -> DataFrame:
    return feed_completeness(t.lineitem, "l_orderkey", "l_returnflag", ["R", "A", "N"])

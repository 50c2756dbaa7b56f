"""Names, clocks, dates, JSON and lists, each over a whole table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source, query
from gamegrain.functions.clocks import age_days, clock_seconds, game_clock, to_day, utc_second
from gamegrain.functions.nested import concat_safe, narrow, ordered_by, parallel_arrays
from gamegrain.functions.text import fold_ascii, fold_ascii_udf, full_name, split_ratio
from gamegrain.operators import gates
from gamegrain.operators.timelines import ordered_lists, sorted_items


@query("""
    SELECT o_orderkey, concat_ws(' ', CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END,
                                 CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END) AS name
    FROM orders
""")
def full_name_parts(t: Source) -> DataFrame:
    """A missing part leaves no blank; without any part the name is empty."""
    first = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    last = F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", full_name(first, last).alias("name"))


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS made,
           CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN NULL
                ELSE CAST(l_quantity AS INTEGER) END AS attempts
    FROM lineitem
""")
def split_ratio_parts(t: Source) -> DataFrame:
    """``made/attempts`` texts; one kind has no second part, one no numbers."""
    number, quantity = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    ratio = F.when(F.col("l_linenumber") == 6, number).when(F.col("l_linenumber") == 7, F.lit("a/b")).otherwise(
        F.concat(number, F.lit("/"), quantity)
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", split_ratio(ratio, 0).alias("made"), split_ratio(ratio, 1).alias("attempts")
    )


@query("""
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS second,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS day, datediff('hour', ts, TIMESTAMP '2030-01-01') // 24 >= 0 AS old
    FROM events
""")
def utc_second_and_day(t: Source) -> DataFrame:
    """ISO texts with fractions of a second → time stamps cut to the second, and dates."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return t.events.select(
        "event_id", F.date_format(utc_second(iso), "yyyy-MM-dd HH:mm:ss").alias("second"),
        to_day(F.substring(iso, 1, 10)).cast("string").alias("day"),
        (age_days(utc_second(iso), F.to_timestamp(F.lit("2030-01-01"))) >= 0).alias("old"),
    )


_FOLDED = "SELECT doc_id, md5(replace(strip_accents(text), 'ß', 'ss')) AS folded FROM documents"


@query(_FOLDED)
def fold_ascii_texts(t: Source) -> DataFrame:
    return t.documents.select("doc_id", F.md5(fold_ascii(F.col("text"))).alias("folded"))


@query(_FOLDED)
def fold_ascii_texts_udf(t: Source) -> DataFrame:
    return t.documents.select("doc_id", F.md5(fold_ascii_udf(F.col("text"))).alias("folded"))


_CLOCK = "lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')"


@query(f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE (l_suppkey % 20) * 60 + l_partkey % 60 END AS s,
           CASE WHEN l_linenumber = 1 THEN {_CLOCK} WHEN l_linenumber = 5 THEN '65:00' WHEN l_linenumber = 7 THEN NULL
                ELSE CAST(l_suppkey % 20 + (l_linenumber - 1) * 20 AS VARCHAR) || ':'
                     || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') END AS game_clock
    FROM lineitem
""")
def clock_texts(t: Source) -> DataFrame:
    """Clock of a period → seconds and the clock of the game; period 7 has a text that is no clock."""
    clock = F.concat(
        F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0"),
    )
    clock = F.when(F.col("l_linenumber") != 7, clock).otherwise(F.lit("none"))
    period = F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", clock_seconds(clock).cast("bigint").alias("s"),
        game_clock(period, clock).alias("game_clock"),
    )


@query("""
    SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS lines
    FROM lineitem GROUP BY l_orderkey
""")
def timeline_lists(t: Source) -> DataFrame:
    """Ordered lists in segments of three, put together again for the comparison."""
    lists = ordered_lists(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey"], max_items=3)
    text = F.array_join(
        F.transform("items", lambda i: F.concat(i["l_linenumber"].cast("string"), F.lit(":"), i["l_partkey"].cast("string"))), ","
    )
    parts = lists.select("l_orderkey", F.struct("segment", text.alias("text")).alias("part"))
    whole = F.sort_array(F.collect_list("part")).getField("text")
    return parts.groupBy("l_orderkey").agg(F.array_join(whole, ",").alias("lines"))


def _orders_with_lines(t: Source) -> DataFrame:
    """One document per order with its lines in a list."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.struct("l_returnflag", "l_linestatus").alias("flags"))
    return t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))


@query("""
    SELECT l_orderkey, string_agg(l_suppkey, ',' ORDER BY l_suppkey, l_linenumber) AS suppliers,
           string_agg(l_linenumber, ',' ORDER BY l_suppkey, l_linenumber) AS numbers FROM lineitem GROUP BY l_orderkey
""")
def comparator_sort(t: Source) -> DataFrame:
    """A list of structs sorted by one field, equal ones in their old order; then one list per field."""
    rows = _orders_with_lines(t).withColumn("sorted", ordered_by(F.col("lines"), "l_suppkey"))
    suppliers, numbers = parallel_arrays("sorted", ["l_suppkey", "l_linenumber"])
    return rows.select("l_orderkey", F.array_join(suppliers.cast("array<string>"), ",").alias("suppliers"),
                       F.array_join(numbers.cast("array<string>"), ",").alias("numbers"))


@query("""
    SELECT l_orderkey, string_agg(l_partkey || l_returnflag, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS parts,
           string_agg(CASE WHEN l_linestatus = 'F' THEN l_partkey ELSE l_suppkey END, ','
               ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS chosen
    FROM lineitem GROUP BY l_orderkey
""")
def narrow_and_choose(t: Source) -> DataFrame:
    """Wide structs → narrow ones with other names; a NULL list counts as empty when lists are joined."""
    small = narrow(F.col("lines"), [("l_partkey", "part"), ("flags.l_returnflag", "flag")])
    rows = _orders_with_lines(t).withColumn("small", concat_safe(small, F.lit(None).cast("array<struct<part:bigint,flag:string>>")))
    chosen = F.transform("lines", lambda x: F.when(x["flags"]["l_linestatus"] == "F", x["l_partkey"]).otherwise(x["l_suppkey"]))
    return rows.select(
        "l_orderkey",
        F.array_join(F.transform("small", lambda x: F.concat(x["part"].cast("string"), x["flag"])), ",").alias("parts"),
        F.array_join(chosen.cast("array<string>"), ",").alias("chosen"),
    )


@query("""
    SELECT l_suppkey, string_agg(l_partkey || '/' || l_linenumber, ',' ORDER BY l_partkey, l_linenumber, l_orderkey) AS items
    FROM (SELECT *, dense_rank() OVER (ORDER BY l_suppkey) AS r FROM lineitem) GROUP BY l_suppkey
""")
def two_level_sort(t: Source) -> DataFrame:
    """Lists in lists → one list in natural order."""
    inner = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_linenumber")).alias("lines"))
    outer = inner.groupBy("l_suppkey").agg(F.collect_list(F.struct("l_orderkey", "lines")).alias("orders"))
    flat = sorted_items(F.col("orders"), "lines", lambda o, x: F.struct(x["l_partkey"], x["l_linenumber"], o["l_orderkey"]))
    text = F.transform(flat, lambda i: F.concat(i["l_partkey"].cast("string"), F.lit("/"), i["l_linenumber"].cast("string")))
    return outer.select("l_suppkey", F.array_join(text, ",").alias("items"))


@query("SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def parse_json_late(t: Source) -> DataFrame:
    """A list of structs written as JSON text and parsed with a schema; keys it does not name are left out."""
    turns = F.collect_list(F.struct("turn", "role", "text", F.lit(1).alias("extra")))
    stored = t.conversations.groupBy("conv_id").agg(F.to_json(turns).alias("body"))
    parsed = stored.select("conv_id", F.explode(F.from_json("body", "array<struct<turn:bigint,role:string,text:string>>")).alias("m"))
    return parsed.select("conv_id", "m.turn", "m.role", F.md5("m.text").alias("text_md5"))


@query("""
    SELECT o_orderkey, n FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem
    ON o_orderkey = l_orderkey GROUP BY 1) WHERE n > 0
""")
def documents_with_content(t: Source) -> DataFrame:
    """Documents whose lists are all empty drop."""
    lines = _orders_with_lines(t).withColumnRenamed("l_orderkey", "o_orderkey")
    documents = t.orders.select("o_orderkey").join(lines, "o_orderkey", "left")
    return gates.with_content(documents, "lines").select("o_orderkey", F.size("lines").cast("bigint").alias("n"))

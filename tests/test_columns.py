"""Column macros on hand-written values."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gamegrain.functions import clocks, nested, points, text


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


NAMES = [
    ("Olli Määttä", "Olli Maatta"),
    ("Montréal Canadiens", "Montreal Canadiens"),
    ("Strauß Ørsted Łukasz Ægir Þór œuvre", "Strauss Orsted Lukasz AEgir Thor oeuvre"),
    ("Slavkovský Ďaloga Čech", "Slavkovsky Daloga Cech"),
    ("e\u0301te\u0301", "ete"),
    ("plain", "plain"),
    ("", ""),
    (None, None),
]


def test_fold_ascii_native_and_udf_agree(spark):
    rows = [(name,) for name, _ in NAMES]
    expected = [folded for _, folded in NAMES]
    assert values(spark, rows, "s string", text.fold_ascii(F.col("s"))) == expected
    assert values(spark, rows, "s string", text.fold_ascii_udf(F.col("s"))) == expected


def test_full_name_skips_null(spark):
    rows = [("Olli", "M"), (None, "M"), (None, None)]
    assert values(spark, rows, "a string, b string", text.full_name("a", "b")) == ["Olli M", "M", ""]


def test_split_ratio_and_whole_number(spark):
    rows = [("1/3",), ("0/0",), ("2",), ("x/y",), ("1.5/2.7",), (None,)]
    assert values(spark, rows, "s string", text.split_ratio(F.col("s"), 0)) == [1, 0, 2, None, 1, None]
    assert values(spark, rows, "s string", text.split_ratio(F.col("s"), 1)) == [3, 0, None, None, 2, None]
    assert values(spark, [("12.5",), ("7",), ("",)], "s string", text.whole_number(F.col("s"))) == [12, 7, None]


def test_path_key_is_anchored(spark):
    rows = [("file:/DATA/ABC/2025-10-07/BOS_roster.parquet",), ("s3a://BUCKET/MTL_roster.json",), ("/DATA/x.parquet",)]
    assert values(spark, rows, "p string", text.path_key(F.col("p"))) == ["BOS", "MTL", None]


def test_clock_seconds(spark):
    rows = [("12:34",), ("00:00",), ("65:00",), ("bad",), (None,)]
    assert values(spark, rows, "c string", clocks.clock_seconds(F.col("c"))) == [754, 0, 3900, None, None]


def test_game_clock(spark):
    rows = [(1, "05:30"), (2, "05:30"), (3, "19:59"), (4, "04:01"), (5, "00:00"), (None, "01:01"), (2, None)]
    clock = clocks.game_clock(F.col("p"), F.col("c"))
    assert values(spark, rows, "p bigint, c string", clock) == [
        "05:30", "25:30", "59:59", "64:01", "65:00", None, None,
    ]
    seconds = clocks.game_seconds(F.col("p"), F.col("c"))
    assert values(spark, rows, "p bigint, c string", seconds) == [330, 1530, 3599, 3841, 3900, None, None]


def test_utc_second(spark):
    rows = [("2025-10-08T23:00:00Z",), ("2025-10-08T19:00:00.750-04:00",), ("2025-10-08T23:00:00",), ("x",)]
    shown = F.date_format(clocks.utc_second(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSS")
    assert values(spark, rows, "t string", shown) == ["2025-10-08 23:00:00.000"] * 3 + [None]


def test_to_day_and_age(spark):
    day = clocks.to_day(F.col("d")).cast("string")
    assert values(spark, [("1994-08-22",), ("1994-02-30",), (None,)], "d string", day) == ["1994-08-22", None, None]
    age = clocks.age_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    rows = [("2025-01-01 12:00:00", "2025-01-02 11:59:59"), ("2025-01-01 12:00:00", "2025-01-03 12:00:00")]
    assert values(spark, rows, "a string, b string", age) == [0, 2]


def test_periods(spark):
    rows = clocks.periods(spark, "2025-10-07", "2026-04-17").orderBy("period_start").collect()
    expected = pd.date_range("2025-10-07", "2026-04-17", freq="7D")
    assert [row.period_start for row in rows] == [stamp.date() for stamp in expected]
    assert len(rows) == 28 and all((row.period_end - row.period_start).days == 6 for row in rows)


@pytest.mark.parametrize(
    "own, other, period, expected",
    [(3, 2, "REG", 2), (3, 2, "OT", 2), (2, 3, "REG", 0), (2, 3, "OT", 1), (2, 3, "SO", 1), (2, 3, None, 0)],
)
def test_result_points(spark, own, other, period, expected):
    column = points.result_points(F.col("a"), F.col("b"), F.col("p"))
    assert values(spark, [(own, other, period)], "a int, b int, p string", column) == [expected]


def test_rate_or_zero(spark):
    rows = [(1, 4), (0, 0), (None, None)]
    assert values(spark, rows, "a int, b int", points.rate_or_zero(F.col("a"), F.col("b"))) == [0.25, 0.0, None]


def test_concat_safe_and_ordered_by(spark):
    rows = [([1], None), (None, None), ([1], [2])]
    column = nested.concat_safe(F.col("a"), F.col("b"))
    assert values(spark, rows, "a array<int>, b array<int>", column) == [[1], [], [1, 2]]
    stars = [([(3, 30), (1, 10), (2, 20)],)]
    ordered = nested.ordered_by(F.col("s"), "star").getField("id")
    assert values(spark, stars, "s array<struct<star:int,id:int>>", ordered) == [[10, 20, 30]]


def test_cell_takes_the_first_match(spark):
    rows = [([("sog", "30"), ("hits", "7"), ("sog", "99")],), ([],), (None,)]
    column = nested.cell(F.col("s"), F.lit("sog"), "k", "v")
    assert values(spark, rows, "s array<struct<k:string,v:string>>", column) == ["30", None, None]


def test_schema_round_trip():
    from gamegrain.sources.feeds import FEEDS, document_schema

    for feed in FEEDS:
        flat = document_schema(feed)
        again = nested.nest_schema(flat)
        leaves = []

        def walk(schema, parents=()):
            for item in schema.fields:
                if hasattr(item.dataType, "fields"):
                    walk(item.dataType, (*parents, item.name))
                else:
                    leaves.append(".".join((*parents, item.name)))

        walk(again)
        assert sorted(leaves) == sorted(flat.names)

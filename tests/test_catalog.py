"""The registered queries: entry point, names, and lists of every length."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from gamegrain.operators.timelines import ordered_lists


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("rows", [1, 4, 5, 6, 13])
def test_lists_have_one_shape_for_every_length(spark, rows):
    data = [(key, i) for key in (1, None) for i in range(rows)]
    out = ordered_lists(spark.createDataFrame(data, "key int, n int"), ["key"], ["n"], max_items=5).collect()
    assert Counter((r.key, r.segment, len(r["items"])) for r in out) == Counter(
        (key, s, min(5, rows - 5 * s)) for key in (1, None) for s in range(-(-rows // 5))
    )
    for r in out:
        assert [i.n for i in r["items"]] == list(range(5 * r.segment, min(rows, 5 * r.segment + 5)))


def test_flow_invariants(spark, sf_dir):
    """Two rows a game, mirrored shots, and lists of equal length."""
    known = __spark_entry__.queries()
    stats = known["team_game_stats_flow"](spark, sf_dir)
    games = stats.groupBy("game_id").agg(F.count("*").alias("n"), F.sum(F.col("shots_on_goal") - F.col("shots_against")).alias("d"))
    assert games.where("n <> 2 OR d <> 0").isEmpty()
    lists = known["game_results_flow"](spark, sf_dir)
    sizes = [F.size(F.split(name, ",")) for name in ("times", "scorers", "assists")]
    assert lists.where((sizes[0] != sizes[1]) | (sizes[0] != sizes[2])).isEmpty()

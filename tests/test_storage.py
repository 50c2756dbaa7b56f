"""What storage promises: keys once, whole appends, pruned writes, the newest snapshot."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gamegrain.operators.gates import GateError
from gamegrain.plans.landing import Landing
from gamegrain.plans.loads import Loads
from gamegrain.sinks.contracts import ID, TEAM_META, TEXT, TableSpec
from gamegrain.sinks.documents import put_documents
from gamegrain.sinks.tables import Table
from gamegrain.sources.feeds import landed_schema

SCHEMA = "id bigint, body string, at int"
SPEC = TableSpec("things", {"id": ID, "body": TEXT}, ("id",))


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("id bigint, body string").parquet(path).select("id", "body").collect())


def test_one_document_a_key(spark, tmp_path):
    path = str(tmp_path / "docs")
    put_documents(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "a", 1), (25_000, "c", 1)], SCHEMA), path, "id", "at")
    assert stored(spark, path) == [(1, "b"), (25_000, "c")]
    put_documents(spark.createDataFrame([(2, "d", 1), (1, "e", 3)], SCHEMA), path, "id", "at")
    put_documents(spark.createDataFrame([], SCHEMA), path, "id", "at")
    assert stored(spark, path) == [(1, "e"), (2, "d"), (25_000, "c")]
    with pytest.raises(GateError):
        put_documents(spark.createDataFrame([(None, "n", 1), (3, "f", 1)], SCHEMA), path, "id", "at")
    assert stored(spark, path) == [(1, "e"), (2, "d"), (25_000, "c")]


def test_other_blocks_keep_their_files(spark, tmp_path):
    path = tmp_path / "docs"
    put_documents(spark.createDataFrame([(i * 10_000, "a", 1) for i in range(4)], SCHEMA), str(path), "id", "at")
    before = {f for f in path.rglob("*.parquet")}
    put_documents(spark.createDataFrame([(10_001, "b", 1)], SCHEMA), str(path), "id", "at")
    after = {f for f in path.rglob("*.parquet")}
    assert {f.parent.name for f in before - after} == {"block=1"} and len(before & after) == 3


def test_unpublished_append_does_not_exist(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), SPEC)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, body string")
    assert table.read().isEmpty()
    table.compact()
    assert table.read().isEmpty()
    table.append(rows)
    table.append_new(spark.createDataFrame([(2, "x"), (3, "c")], "id bigint, body string"))
    table._write(rows.withColumn("id", F.col("id") + 50), table._new_snapshot())  # a job that died before it ended
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "b"), (3, "c")]
    table.append_new(rows)
    assert table.read().count() == 3
    with pytest.raises(GateError):
        table.replace(rows.where("id > 9"))
    assert table.read().count() == 3
    table.replace(rows.where("id = 1"))
    table.append(rows.where("id = 2"))
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a"), (2, "b")]


def test_team_documents_of_all_parts(spark, tmp_path):
    name = {"default": "x"}
    schema = landed_schema("team_meta")
    landed = str(tmp_path / "landed")
    docs = spark.createDataFrame(
        [{"teams": [{"teamId": i, "tricode": code, "name": name}], "updated_at": "2025-10-01T00:00:00+00:00"}
         for i, code in ((1, "BOS"), (2, "MTL"))], schema)
    docs.withColumn("loaded_on", F.lit("2025-10-01").cast("date")).repartition(2).write.partitionBy("loaded_on").parquet(f"{landed}/team_meta")
    loads = Loads(spark, landed, str(tmp_path / "tables"))
    assert loads.team_meta(datetime(2025, 10, 2))
    assert {r.team_id for r in loads.table(TEAM_META).read().collect()} == {1, 2}


def test_games_of_closed_weeks_come_again(spark, tmp_path):
    raw = tmp_path / "raw" / "schedule"
    raw.mkdir(parents=True)
    (raw / "2025-10-06.json").write_text(
        '{"gameWeek": [{"date": "2025-10-07", "numberOfGames": 1, "games": [{"id": 2025020001, "gameType": 2, "gameState": "%s"}]}]}'
        % Landing.final_state)
    periods = spark.sql("SELECT date'2025-10-06' AS period_start, date'2025-10-12' AS period_end")
    for day in (10, 30):
        run = Landing(spark, str(tmp_path / "raw"), str(tmp_path / "out"), datetime(2025, 10, day))
        assert [r.game_id for r in run.schedule(periods).collect()] == [2025020001]


def test_documents_are_read_one_at_a_time(spark, tmp_path):
    """Rows with nested items are not held by thousands as columns; flat tables are read in batches."""
    for name, items, batched in (("nested", "sequence(0, id)", False), ("flat", "id", True)):
        spark.range(9).selectExpr("id", f"{items} AS items").write.parquet(f"{tmp_path}/{name}")
        plan = spark.read.parquet(f"{tmp_path}/{name}")._jdf.queryExecution().executedPlan().toString()
        assert f"Batched: {str(batched).lower()}" in plan

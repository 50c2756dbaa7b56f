"""Streams of new files, loads that are stored once, and reads that open only what they need."""

import re
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source
from gamegrain.catalog.storage import bucketed_orders, reassembled
from gamegrain.operators.gates import GateError
from gamegrain.operators.observed import Gate, counted_write
from gamegrain.operators.pivots import pivot_map
from gamegrain.operators.versions import latest_by
from gamegrain.plans import boxscores
from gamegrain.plans.loads import Loads
from gamegrain.sinks import keycounts
from gamegrain.sinks.batches import BatchWriter, insert_once, stored_batches
from gamegrain.sinks.contracts import ID, SKATER_GAME_STATS, TEXT, TableSpec
from gamegrain.sinks.documents import put_documents
from gamegrain.sinks.tables import Table
from gamegrain.sinks.versioned import VersionedTable
from gamegrain.sources.drift import common_schema, drifted, parse_drifting
from gamegrain.sources.feeds import landed_schema
from gamegrain.sources.inventory import file_inventory
from gamegrain.sources.keyed import keyed_scan
from gamegrain.sources.listing import listed_files, newest_snapshot
from gamegrain.streaming.arrivals import follow_files, follow_into

SCHEMA = "id bigint, body string"
SPEC = TableSpec("things", {"id": ID, "body": TEXT}, ("id",))


def things(spark, *ids):
    return spark.createDataFrame([(i, f"b{i}") for i in ids], SCHEMA)


def stored(table):
    return sorted(r.id for r in table.read().collect())


def test_only_new_files_are_delivered(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), SPEC)
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    counts = []
    for ids in ((1, 2), (3,), (), (4, 5)):
        if ids:
            things(spark, *ids).coalesce(1).write.mode("append").parquet(path)
        counts.append(follow_into(table, path, SCHEMA, log))
    assert counts == [1, 1, 0, 1] and stored(table) == [1, 2, 3, 4, 5]


def test_backlog_in_parts(spark, tmp_path):
    path, sizes = str(tmp_path / "in"), []
    things(spark, *range(8)).repartition(4).write.json(path)
    follow_files(spark, path, SCHEMA, lambda rows, batch: sizes.append(rows.count()), str(tmp_path / "log"), "json", 1)
    assert sum(sizes) == 8 and len(sizes) > 1


def test_batch_that_ran_twice_is_stored_once(spark, tmp_path):
    """The run dies after the append and before its batch counts as done; the next one gets the batch again."""
    table = Table(spark, str(tmp_path / "t"), SPEC)
    path, log = str(tmp_path / "in"), str(tmp_path / "log")
    things(spark, 1, 2).write.parquet(path)
    given = []

    def dies_once(rows, batch):
        given.append(batch)
        table.append_once(rows, f"files-{batch:012d}")
        if len(given) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        follow_files(spark, path, SCHEMA, dies_once, log)
    assert stored(table) == [1, 2]
    things(spark, 3).write.mode("append").parquet(path)
    follow_files(spark, path, SCHEMA, dies_once, log)
    assert given[:2] == [0, 0] and stored(table) == [1, 2, 3]


def test_delivery_after_a_replacement(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), SPEC)
    assert table.append_once(things(spark, 1), "d-1")
    table.replace(things(spark, 7))
    assert not table.append_once(things(spark, 1), "d-1") and table.append_once(things(spark, 8), "d-2")
    table._write(things(spark, 9, 10), "d-3")  # a run that died before it published
    assert stored(table) == [7, 8]
    assert table.append_once(things(spark, 9), "d-3") and stored(table) == [7, 8, 9]


def test_load_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "b")
    nested = spark.createDataFrame([(i, [i, None], (f"x{i}",)) for i in range(25)], "id long, l array<long>, s struct<t:string>")
    for load in ("a", "a", "b"):
        insert_once(nested, path, load, batch_rows=4)
    rows = stored_batches(spark, path, nested.schema)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([*map(tuple, nested.collect())] * 2, key=repr)
    assert sorted(p.stem for p in Path(path).glob("published/*.json")) == ["a", "b"]
    empty = str(tmp_path / "none")
    insert_once(nested.where("false"), empty, "a")
    assert stored_batches(spark, empty, nested.schema).collect() == []


def test_failed_load_stores_nothing(spark, tmp_path):
    path = str(tmp_path / "b")
    broken = things(spark, *range(40)).repartition(4).withColumn("body", F.when(F.col("id") == 39, F.raise_error(F.lit("no"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="no"):
        insert_once(broken, path, "a", batch_rows=2)
    assert stored_batches(spark, path, SCHEMA).collect() == []
    insert_once(things(spark, 1), path, "a")
    assert stored_batches(spark, path, SCHEMA).count() == 1


def test_repeated_task_counts_once(tmp_path):
    """A session that repeats tasks: one of them fails after it has sent part of its rows."""
    script = f"""
        import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from gamegrain.sinks.batches import insert_once, stored_batches
        spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
                 .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate())
        def once(batches):
            for n, batch in enumerate(batches):
                if n == 2 and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                    raise RuntimeError("lost in the middle")
                yield batch
        rows = spark.range(0, 200, 1, 4).mapInArrow(once, "id long")
        insert_once(rows, {str(tmp_path / "b")!r}, "a", batch_rows=7)
        found = sorted(r.id for r in stored_batches(spark, {str(tmp_path / "b")!r}, "id long").collect())
        assert found == list(range(200)), len(found)
        print("whole")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert "whole" in done.stdout, done.stderr[-2000:]


def test_commit_of_a_second_run_removes_its_files(spark, tmp_path):
    import pyarrow as pa

    rows = [pa.record_batch({"id": [1, 2, 3]})]
    first, second = (BatchWriter({"path": str(tmp_path), "load": "a", "batch_rows": 2}, None) for _ in range(2))
    written = [w.write(iter(rows)) for w in (first, second)]
    first.commit([written[0], None])
    second.commit([written[1]])
    assert [f.rows for f in written] == [3, 3] and len(list(tmp_path.glob("staged/*/*.parquet"))) == 1


def test_predicate_reaches_the_target(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.createDataFrame([(i, f"s{i % 3}", None if i % 5 else i) for i in range(60)], "id long, status string, n long")
    insert_once(rows, path, "a", batch_rows=10)
    found = stored_batches(spark, path, rows.schema).where("status = 's1' AND id > 20 AND n IS NOT NULL AND id IN (25, 40, 55, 58)")
    assert sorted(r.id for r in found.collect()) == [25, 40, 55]
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "EqualTo(status,s1)" in plan and "GreaterThan(id,20)" in plan


def files_read(df):
    """Files that the scans of a frame opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return sum(int(x) for x in re.findall(r"numFiles=(\d+)", metrics_of(plan)))


def metrics_of(plan):
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        found = node.metrics().get("numFiles")
        if found.isDefined():
            out.append(f"numFiles={found.get().value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return " ".join(out)


def test_files_without_wanted_keys_are_not_read(spark, tmp_path):
    path = str(tmp_path / "docs")
    put_documents(things(spark, *range(0, 2_000, 10)), path, "id", block_keys=100)
    docs = spark.read.schema(f"{SCHEMA}, block bigint").parquet(path)
    keys = spark.createDataFrame([(500,), (510,), (1_990,), (7,), (None,)], "id bigint")
    found = keyed_scan(docs, keys, "id", 100)
    assert files_read(found) == 3 and sorted(r.id for r in found.collect()) == [500, 510, 1_990]
    assert keyed_scan(docs, keys.where("id = 7"), "id", 100).collect() == []
    assert keyed_scan(docs, keys.where("false"), "id", 100).collect() == []


def test_one_night_writes_one_block(spark, tmp_path):
    path = tmp_path / "docs"
    put_documents(things(spark, *range(2024020001, 2024021001)), str(path), "id", block_keys=100)
    before = set(path.rglob("*.parquet"))
    put_documents(things(spark, *range(2024020501, 2024020511)), str(path), "id", block_keys=100)
    after = set(path.rglob("*.parquet"))
    assert len(before) == 11 and len(before - after) == 1 and len(after) == 11


def test_compaction_touches_changed_buckets_only(spark, tmp_path):
    spec = TableSpec("versions", {"id": ID, "body": TEXT, "at": ID}, ("id",), version="at")
    table = VersionedTable(spark, str(tmp_path / "v"), spec, 8)
    rows = spark.range(200).select("id", F.lit("old").alias("body"), F.lit(1).alias("at"))
    assert table.read().isEmpty() and table.compact() == []
    assert table.append(rows) == list(range(8)) == table.compact() and table.compact() == []
    newer = rows.where("id IN (3, 4)").withColumn("body", F.lit("new")).withColumn("at", F.lit(2))
    changed = table.append(newer)
    assert table.read().count() == 202 and table.latest().count() == 200
    assert table.compact() == changed and len(changed) <= 2
    assert {p.name for p in max((tmp_path / "v" / "snapshots").iterdir()).glob("bucket=*")} == {f"bucket={b}" for b in changed}
    assert {r.body: r.n for r in table.read().groupBy("body").agg(F.count("*").alias("n")).collect()} == {"old": 198, "new": 2}
    assert table.append(rows.where("false")) == [] and table.compact() == []


def box(spark, *ids):
    schema = landed_schema("boxscore")
    skater = {"playerId": 8, "name": {"default": "A"}, "position": "C", "sweaterNumber": 9, "goals": 1, "assists": 0, "points": 1,
              "plusMinus": 0, "pim": 0, "powerPlayGoals": 0, "sog": 1, "hits": 0, "blockedShots": 0, "faceoffWinningPctg": 0.0,
              "giveaways": 0, "takeaways": 0, "shifts": 3, "toi": "10:00"}
    rows = []
    for i in ids:
        row = {"id": i, "season": 20242025, "startTimeUTC": "2024-10-08T20:30:00Z", "updated_at": "2024-10-09T00:00:00"}
        for side in ("home", "away"):
            row |= {f"{side}Team.id": 1, f"{side}Team.abbrev": "AAA", f"{side}Team.placeName.default": "P", f"{side}Team.commonName.default": "C"}
            row |= {f"playerByGameStats.{side}Team.{group}": [skater] if group == "forwards" else [] for group in ("forwards", "defense", "goalies")}
        rows.append(tuple(row[f.name] for f in schema.fields))
    return spark.createDataFrame(rows, schema)


def test_games_of_new_files_only(spark, tmp_path):
    loads = Loads(spark, str(tmp_path / "landed"), str(tmp_path / "tables"))
    path, log = f"{loads.landed}/boxscore", str(tmp_path / "log")

    def follow():
        return loads.follow_games(SKATER_GAME_STATS, "boxscore", boxscores.skater_game_stats, log)

    put_documents(box(spark, 101, 102, 901), path, "id", "updated_at", 100)
    assert follow() == 1
    put_documents(box(spark, 103), path, "id", "updated_at", 100)  # the block of 101 and 102 is written again
    assert follow() == 1 and follow() == 0
    table = loads.table(SKATER_GAME_STATS)
    assert sorted((r.game_id, r.team_type) for r in table.read().collect()) == [(g, s) for g in (101, 102, 103, 901) for s in ("away", "home")]
    put_documents(box(spark, 950), path, "id", "updated_at", 100)
    assert loads.boxscores()[0] is True and loads.boxscores()[0] is False
    assert table.read().count() == 10


def plan_of(df):
    return spark_plan(df).lower()


def spark_plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_buckets_need_no_exchange(spark, sf_dir):
    orders, lines = bucketed_orders(Source(spark, sf_dir))
    joined = reassembled(orders, lines)
    newest = latest_by(lines.select("order_key", "l_linenumber"), ["order_key"], "l_linenumber")
    opponent = lines.join(lines.withColumnRenamed("l_linestatus", "other"), "order_key")
    for df in (joined, newest, opponent.hint("merge")):
        assert "exchange" not in plan_of(df).replace("broadcastexchange", "")
    assert "exchange" in plan_of(lines.groupBy("l_linenumber").count())


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    rows = things(spark, *range(1, 11))
    assert counted_write(rows, str(tmp_path / "a"), Gate("id", 10)) == 10
    for wrong in (Gate("id", 9), Gate("id", 11)):
        with pytest.raises(GateError):
            counted_write(rows, str(tmp_path / f"w{wrong.distinct}"), wrong)
    for ids in ((0, 1), (1, 32_769), (-5, 2)):
        with pytest.raises(GateError, match="outside"):
            counted_write(things(spark, *ids), str(tmp_path / f"o{ids[0]}"), Gate("id", 2))
    with pytest.raises(GateError, match="no rows"):
        counted_write(rows.where("false"), str(tmp_path / "none"))
    nulls = spark.createDataFrame([(None, "x"), (3, "y"), (32_768, "z")], SCHEMA)
    assert counted_write(nulls, str(tmp_path / "n"), Gate("id", 2)) == 3


def test_listing_equals_the_inventory(spark, tmp_path):
    root = str(tmp_path / "r")
    things(spark, *range(20)).withColumn("day", F.concat(F.lit("2024-01-0"), F.col("id") % 3 + 1)).write.partitionBy("day").parquet(root)
    things(spark, 1).coalesce(1).write.mode("append").json(root)
    (tmp_path / "r" / "_hidden").mkdir()
    (tmp_path / "r" / "_hidden" / "x.json").write_text("{}")
    ours = {(r.name, r.length, r.modified_at.replace(microsecond=0)) for r in listed_files(spark, root).collect()}
    theirs = {(r.name, r.length, r.modified_at.replace(microsecond=0)) for r in file_inventory(spark, root).collect()}
    assert ours == theirs and len(ours) > 3
    assert listed_files(spark, str(tmp_path / "missing")).collect() == []
    schema = things(spark, 1).schema.add("day", "string")
    rows = newest_snapshot(spark, root, schema, "day")
    assert sorted(r.id for r in rows.collect()) == [2, 5, 8, 11, 14, 17] and {r.day for r in rows.collect()} == {"2024-01-03"}
    assert newest_snapshot(spark, str(tmp_path / "missing"), schema, "day").collect() == []


def test_bitmaps_merge(spark, tmp_path):
    path = str(tmp_path / "k")
    assert keycounts.distinct_keys(keycounts.stored_keys(spark, path)).first().keys == 0
    for load, ids in (("a", (1, 2, 40_000, None, -3)), ("b", (2, 3, 10**12)), ("a", (1, 5))):
        keycounts.store_keys(spark.createDataFrame([(i,) for i in ids], "id bigint"), path, "id", load)
    assert keycounts.distinct_keys(keycounts.stored_keys(spark, path)).first().keys == 5


def test_map_pivot_takes_any_category(spark):
    rows = spark.createDataFrame([(1, "a", 5, 2), (1, "a", 6, 1), (1, "z.z", None, 1), (2, None, 1, 1), (None, "q", 3, 1)],
                                 "k int, c string, v int, at int")
    out = {r.k: r.attributes for r in pivot_map(rows, ["k"], "c", "v", ["at"]).collect()}
    assert out == {1: {"a": 6, "z.z": None}, None: {"q": 3}}


def test_drift_is_reported(spark):
    lines = ['{"a": 1, "b": "x"}', '{"a": "1", "b": "y"}', '{"a": null, "b": "z"}', '{"a"', None, "[1]", '{"b": {"c": 1}}']
    taken, broken = parse_drifting(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    assert taken.count() == 5 and broken.count() == 2
    assert sorted((r.field, r.types, r.documents) for r in drifted(taken).collect()) == [("a", 2, 2), ("b", 2, 4)]
    assert common_schema(taken).first().schema == "VARIANT"


def test_dotted_columns_keep_their_names(spark):
    rows = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "`a.id` int, `b.c` string, at int")
    out = latest_by(rows, ["a.id"], "at")
    assert out.columns == rows.columns and sorted(map(tuple, out.collect())) == [(1, "new", 2), (2, "x", 1)]


def test_a_backfill_writes_few_folders(spark, tmp_path):
    """Games of many blocks go to one folder a season, later nights to blocks of their own; a game is stored once, wherever it lies."""
    path, first = tmp_path / "docs", 2024020001

    def put(ids, at):
        frame = spark.createDataFrame([(i, at) for i in ids], "id bigint, at int")
        put_documents(frame, str(path), "id", "at", 100, 10_000)

    def folders():
        return {f.parent.name: f for f in path.rglob("*.parquet")}

    put([*range(first, first + 1_000), *range(first + 10_000, first + 11_000)], 1)
    before = folders()
    assert len(before) == 2
    put(range(first + 1_000, first + 1_010), 2)
    after = folders()
    assert len(after) == 3 and before.items() <= after.items()
    put([first + 5, first + 1_005, first + 1_006, first + 1_500], 3)
    put(range(first + 900, first + 2_900), 4)
    rows = spark.read.schema("id bigint, at int, block bigint").parquet(str(path))
    at = {r.id: r.at for r in rows.collect()}
    wanted = dict.fromkeys([*range(first, first + 1_000), *range(first + 10_000, first + 11_000)], 1) | {first + 5: 3}
    assert rows.count() == len(at) == 3_900 and at == wanted | dict.fromkeys(range(first + 900, first + 2_900), 4)
    assert len(folders()) == 4
    keys = spark.createDataFrame([(first + 5,), (first + 1_005,), (first + 10_000,), (1,)], "id bigint")
    found = keyed_scan(rows, keys, "id", 100, wide_keys=10_000)
    assert sorted(r.id for r in found.collect()) == [first + 5, first + 1_005, first + 10_000] and files_read(found) <= 3


def test_a_backfill_over_blocks_of_a_night(spark, tmp_path):
    """Storage of an earlier version, in blocks of 100 only, keeps its games there; they are replaced, not doubled."""
    path = str(tmp_path / "docs")
    frame = spark.range(5_000, 6_500).select("id", F.lit(1).alias("at"))
    put_documents(frame, path, "id", "at", 100)
    put_documents(spark.range(5_990, 8_000).select("id", F.lit(2).alias("at")), path, "id", "at", 100, 10_000)
    rows = spark.read.schema("id bigint, at int, block bigint").parquet(path)
    assert rows.count() == 3_000 == rows.select("id").distinct().count() and rows.where("at = 2").count() == 2_010
    assert rows.where("id = 6499").select("block").first()[0] == 64 and rows.where("id >= 6500").select("block").distinct().count() == 1

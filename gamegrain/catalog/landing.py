"""Landing of raw JSON documents made from the tables: each run twice, the second one adds nothing."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source, query
from gamegrain.plans.landing import Landing
from gamegrain.session import scratch_path
from gamegrain.sinks.documents import put_documents
from gamegrain.sources.inventory import newest_file
from gamegrain.sources.listing import listed_files
from gamegrain.sources.lookups import FINAL_STATE
from gamegrain.streaming.increments import reload_due

LOADED_AT = datetime(2025, 1, 2, 3, 4, 5)
LATER = datetime(2025, 1, 3, 3, 4, 5)
STAMP = "2025-01-02T03:04:05"


def _runs(t: Source) -> tuple[Landing, Landing]:
    """A run, and one of the next day over the same raw files."""
    raw, out = scratch_path(t.spark, "raw"), scratch_path(t.spark, "landed")
    return tuple(Landing(t.spark, raw, out, at, multiline=False, game_types=(2, 3)) for at in (LOADED_AT, LATER))


def _write(run: Landing, feed: str, documents: DataFrame, folder: str | None = None) -> None:
    """One document per line; ``folder`` splits the raw area into ``name=value`` folders."""
    body = F.to_json(F.struct(*[c for c in documents.columns if c != folder])).alias("value")
    lines = documents.select(body, *([folder] if folder else []))
    writer = lines.write.mode("append")
    (writer.partitionBy(folder) if folder else writer).text(f"{run.raw}/{feed}")


def _named(text: Column) -> Column:
    return F.struct(text.alias("default"))


@query(f"""
    SELECT n_nationkey AS team_id, substr(n_name, 1, 3) AS tricode, n_name AS name, '{STAMP}' AS updated_at, 'true,false' AS landed
    FROM nation
""")
def landing_team_meta(t: Source) -> DataFrame:
    """Team documents, one of them without teams; the second run finds them stored and lands nothing."""
    first, second = _runs(t)
    team = F.struct(F.col("n_nationkey").alias("teamId"), F.substring("n_name", 1, 3).alias("tricode"), _named(F.col("n_name")).alias("name"))
    documents = t.nation.groupBy("n_regionkey").agg(F.collect_list(team).alias("teams")).drop("n_regionkey")
    _write(first, "team_meta", documents.unionByName(documents.limit(1).select(F.slice("teams", 1, 0).alias("teams"))))
    landed = ",".join(str(run.team_meta()).lower() for run in (first, second))
    teams = second.landed("team_meta", "loaded_on date").select(F.explode("teams").alias("team"), "updated_at")
    return teams.select(
        F.col("team.teamId").alias("team_id"), "team.tricode", F.col("team.name.default").alias("name"), "updated_at",
        F.lit(landed).alias("landed"))


@query("""
    SELECT n_name AS team, c_custkey AS player_id, snapshots
    FROM customer JOIN nation ON c_nationkey = n_nationkey, (SELECT 2 AS snapshots)
""")
def landing_rosters(t: Source) -> DataFrame:
    """Snapshots of two days, team codes from the path; the ids of all lists of a document, each once."""
    first, second = _runs(t)
    player = F.struct(F.col("c_custkey").alias("id"))
    lists = [F.collect_list(F.when(F.col("c_custkey") % 3 == i, player)).alias(n) for i, n in enumerate(("forwards", "defensemen", "goalies"))]
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    documents = named.groupBy(F.col("n_name").alias("team")).agg(*lists)
    none = F.array().cast(documents.schema["forwards"].dataType)
    _write(first, "team_rosters", documents.unionByName(t.nation.limit(1).select(
        F.lit("EMPTY").alias("team"), none.alias("forwards"), none.alias("defensemen"), none.alias("goalies"))), "team")
    first.team_rosters()
    ids = second.team_rosters()
    stored = second.landed("team_rosters", "team_abbrev string", "snapshot_date date")
    days = stored.groupBy("team_abbrev").agg(F.count_distinct("snapshot_date").cast("int").alias("snapshots"))
    newest = stored.where(F.col("snapshot_date") == F.lit(LATER.date()))
    listed = newest.select(F.col("team_abbrev").alias("team"), F.explode(F.concat("forwards", "defensemen", "goalies")).alias("p"))
    rows = listed.select("team", F.col("p.id").alias("player_id")).join(ids, "player_id")
    return rows.join(days, F.col("team") == F.col("team_abbrev")).select("team", "player_id", "snapshots")


def _weeks(t: Source, orders: DataFrame) -> DataFrame:
    """One document per week of orders; days without games, and weeks of such days only."""
    game = F.struct(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 4).alias("gameType"),
        F.when(F.col("o_orderstatus") == "F", FINAL_STATE).otherwise("FUT").alias("gameState"))
    played = F.col("o_orderkey") % 5 != 0
    days = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.collect_list(F.when(played & (F.month("o_orderdate") != 2), game)).alias("games"))
    entry = F.struct(F.size("games").alias("numberOfGames"), "games")
    return days.groupBy(F.to_date(F.date_trunc("week", "day")).alias("week")).agg(F.collect_list(entry).alias("gameWeek"))


def _periods(weeks: DataFrame) -> DataFrame:
    return weeks.select(F.col("week").alias("period_start"), F.date_add("week", 6).alias("period_end"))


_PLAYED = "o_orderkey % 5 <> 0 AND month(o_orderdate) <> 2"


@query(f"""
    SELECT o_orderkey AS game_id, weeks.n AS weeks
    FROM orders, (SELECT count(DISTINCT date_trunc('week', o_orderdate)) AS n FROM orders WHERE {_PLAYED}) weeks
    WHERE o_orderstatus = 'F' AND o_orderkey % 4 IN (2, 3) AND {_PLAYED} AND o_orderkey % 3 <> 0
""")
def landing_schedule(t: Source) -> DataFrame:
    """Weeks with games land, those without do not; finished games that all feeds have are not new. In the second
    run the weeks are closed, and what their files say then is not read."""
    first, second = _runs(t)
    weeks = _weeks(t, t.orders)
    _write(first, "schedule", weeks, "week")
    for feed in ("boxscore", "play_by_play", "game_story"):
        put_documents(t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.lit("x").alias("updated_at")),
                      f"{first.out}/{feed}", "id", "updated_at")
    once = first.schedule(_periods(weeks))
    _write(first, "schedule", _weeks(t, t.orders.withColumn("o_orderstatus", F.lit("F"))), "week")
    again = second.schedule(_periods(weeks))
    stored = second.landed("schedule", "period_start date").agg(F.count("*").alias("weeks"))
    return once.join(again, "game_id").crossJoin(F.broadcast(stored))


def _games(t: Source) -> DataFrame:
    """Every third order is a game of the night."""
    return t.orders.where("o_orderkey % 3 = 1").select(F.col("o_orderkey").alias("game_id"))


@query("""
    SELECT l_partkey AS player_id, count(DISTINCT l_orderkey) AS games, 1 AS documents_per_game
    FROM lineitem WHERE l_orderkey % 3 = 1 GROUP BY 1
""")
def landing_play_by_play(t: Source) -> DataFrame:
    """Documents of the wanted games only, put twice under one key; the ids of their players."""
    first, second = _runs(t)
    spot = F.struct(F.col("l_partkey").alias("playerId"))
    _write(first, "play_by_play", t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(spot).alias("rosterSpots")))
    first.play_by_play(_games(t))
    ids = second.play_by_play(_games(t))
    stored = second.landed("play_by_play")
    copies = stored.groupBy("id").agg(F.count("*").alias("n")).agg(F.max("n").cast("int").alias("documents_per_game"))
    spots = stored.select("id", F.explode("rosterSpots.playerId").alias("player_id")).distinct()
    counted = spots.groupBy("player_id").agg(F.count("*").alias("games")).join(ids, "player_id")
    return counted.crossJoin(F.broadcast(copies))


@query("""
    SELECT l_orderkey AS id, l_partkey AS player_id, CAST(l_quantity AS BIGINT) AS goals, '2025-01-03T03:04:05' AS updated_at
    FROM lineitem WHERE l_orderkey % 3 = 1 AND l_linestatus = 'F'
""")
def landing_boxscores(t: Source) -> DataFrame:
    """Nested documents flattened to dotted names, stamped with the time of the load that stored them last."""
    first, second = _runs(t)
    line = F.struct(F.col("l_partkey").alias("playerId"), F.col("l_quantity").cast("long").alias("goals"), F.lit("?").alias("unknown"))
    lines = t.lineitem.where("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(line).alias("f"))
    side = F.struct(F.struct(F.col("f").alias("forwards")).alias("homeTeam")).alias("playerByGameStats")
    _write(first, "boxscore", lines.select("id", side))
    for run in (first, second):
        run.game_feed("boxscore", _games(t))
    stored = second.landed("boxscore").select(
        "id", F.explode(F.col("`playerByGameStats.homeTeam.forwards`")).alias("p"), "updated_at")
    return stored.select("id", F.col("p.playerId").alias("player_id"), F.col("p.goals").alias("goals"), "updated_at")


@query("""
    SELECT o_orderkey AS id,
           CASE WHEN o_orderkey % 2 = 0 THEN '[{"n":' || o_orderkey || ',"goals":[]}]' ELSE '[]' END AS scoring,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || '/7' END AS away_value, 'x' AS home_value
    FROM orders WHERE o_orderkey % 3 = 1
""")
def landing_game_stories(t: Source) -> DataFrame:
    """The reader's text-typed fields: a list whose structure drifts comes as JSON text, values that are numbers in some
    documents and text in others come as text."""
    first, second = _runs(t)
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    even = F.col("o_orderkey") % 2 == 0
    scoring = F.when(even, F.concat(F.lit('[{"n":'), key, F.lit(',"goals":[]}]'))).otherwise("[]")
    value = F.when(even, customer).otherwise(F.concat(F.lit('"'), customer, F.lit('/7"')))
    line = F.concat(
        F.lit('{"id": '), key, F.lit(', "summary": {"scoring": '), scoring, F.lit(', "teamGameStats": [{"category": "c", "awayValue": '),
        value, F.lit(', "homeValue": "x"}]}}'))
    t.orders.select(line).write.text(f"{first.raw}/game_story")
    for run in (first, second):
        run.game_feed("game_story", _games(t))
    stat = F.col("`summary.teamGameStats`")[0]
    return second.landed("game_story").select(
        "id", F.col("`summary.scoring`").alias("scoring"), stat["awayValue"].alias("away_value"), stat["homeValue"].alias("home_value"))


@query("""
    SELECT c_custkey AS player_id, c_name AS last_name, work.n AS work_list
    FROM customer, (SELECT count(*) AS n FROM (SELECT c_custkey FROM customer WHERE c_nationkey < 12
                                               UNION SELECT o_custkey FROM orders)) work
    WHERE c_nationkey < 12 OR c_custkey IN (SELECT o_custkey FROM orders)
""")
def landing_players(t: Source) -> DataFrame:
    """Rostered players and those of the games, each once; their documents, replaced by the second run."""
    first, second = _runs(t)
    _write(first, "players", t.customer.select(F.col("c_custkey").alias("playerId"), _named(F.col("c_name")).alias("lastName")))
    rostered = t.customer.where("c_nationkey < 12").select(F.col("c_custkey").alias("player_id"))
    listed = t.orders.select(F.col("o_custkey").alias("player_id"))
    first.players(rostered, listed)
    work = second.players(rostered, listed).agg(F.count("*").alias("work_list"))
    stored = second.landed("players").where(F.col("updated_at") == LATER.isoformat())
    return stored.select(F.col("playerId").alias("player_id"), F.col("`lastName.default`").alias("last_name")).crossJoin(F.broadcast(work))


@query("""
    SELECT * FROM (VALUES ('no file', false), ('fresh file, empty table', true), ('old file, empty table', true),
                          ('old file, loaded', false), ('fresh file, loaded', true)) v(state, due)
""")
def reload_rule(t: Source) -> DataFrame:
    """Reference data is loaded once: which states of storage and table make a load due."""
    path = scratch_path(t.spark, "regions")
    empty, loaded = t.region.where("false"), t.region
    at = datetime.now()
    found = [("no file", reload_due(newest_file(listed_files(t.spark, path)), empty, at))]
    t.region.coalesce(1).write.parquet(path)
    newest = newest_file(listed_files(t.spark, path))
    fresh, old = datetime.now(), datetime(date.today().year + 1, 12, 31)
    for state, table in (("empty table", empty), ("loaded", loaded)):
        found += [(f"{age} file, {state}", reload_due(newest, table, now)) for age, now in (("fresh", fresh), ("old", old))]
    return t.spark.createDataFrame(found, "state string, due boolean")


@query("""
    SELECT 1 AS run, count(*) AS games, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderkey % 3 = 1) AS players,
           true AS went_on FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL SELECT 2, 0, 0, false
""")
def early_exit(t: Source) -> DataFrame:
    """A run without new keys ends before it reads documents; its report is a row of zeros."""
    path = scratch_path(t.spark, "loaded-games")
    documents = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    reports = []
    for run in (1, 2):
        loaded = t.spark.read.schema("id bigint").parquet(path) if run > 1 else t.orders.where("false").select(F.col("o_orderkey").alias("id"))
        fresh = _games(t).select(F.col("game_id").alias("id")).join(loaded, "id", "left_anti")
        went_on = not fresh.isEmpty()
        if went_on:
            documents.join(fresh, "id").write.parquet(path)
        new = t.spark.read.schema("id bigint, o_custkey bigint").parquet(path).where(F.lit(went_on))
        reports.append(new.agg(F.count("*").alias("games"), F.count_distinct("o_custkey").alias("players"))
                       .select(F.lit(run).alias("run"), "games", "players", F.lit(went_on).alias("went_on")))
    return reports[0].unionByName(reports[1])

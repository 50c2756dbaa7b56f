"""The shipped flows, on documents made from the tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamegrain.catalog.base import Source, query
from gamegrain.functions.clocks import utc_second
from gamegrain.plans import boxscores, players, schedule, stories, teams
from gamegrain.sources.feeds import landed_schema
from gamegrain.sources.lookups import FINAL_STATE, membership
from gamegrain.streaming.increments import finished_games, played_days

LOADED_AT = "2024-01-02T03:04:05.678Z"


def _named(text: Column) -> Column:
    return F.struct(text.alias("default"))


def _line(t: Source, feed: str, field: str) -> dict[str, str]:
    """Name and type of the fields of a player line as the feed declares them."""
    declared = landed_schema(feed)[field].dataType.elementType
    return {f.name: f.dataType.simpleString() for f in declared.fields}


def _boxscores(t: Source) -> DataFrame:
    """One document per order: finished lines play at home, open ones away; even suppliers are forwards, odd ones
    defense, and the third list has every line as a goalie."""
    values = {
        "playerId": F.col("l_partkey"), "name": _named(F.concat(F.lit("Plåyer "), F.col("l_partkey").cast("string"))),
        "position": F.col("l_returnflag"), "sweaterNumber": F.col("l_linenumber"), "goals": F.col("l_quantity"),
        "saves": F.col("l_quantity"), "starter": F.col("l_linenumber") == 1, "shotsAgainst": F.col("l_suppkey"),
        "sog": F.col("l_suppkey"), "toi": F.concat((F.col("l_partkey") % 60).cast("string"), F.lit(":07")),
    }

    def item(group: str) -> Column:
        kinds = _line(t, "boxscore", f"playerByGameStats.homeTeam.{group}")
        return F.struct(*[values.get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])

    parts = {"forwards": F.col("l_suppkey") % 2 == 0, "defense": F.col("l_suppkey") % 2 == 1, "goalies": F.lit(True)}
    lists = [
        F.collect_list(F.when((F.col("l_linestatus") == status) & here, item(group))).alias(f"playerByGameStats.{side}Team.{group}")
        for side, status in (("home", "F"), ("away", "O")) for group, here in parts.items()
    ]
    documents = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(*lists)
    team = [
        column.alias(f"{side}Team.{name}") for side, shift in (("home", 0), ("away", 1)) for name, column in (
            ("id", F.col("id") + shift), ("abbrev", F.lit(side.upper()[:3])), ("placeName.default", F.lit("Montréal")),
            ("commonName.default", F.lit(side)))
    ]
    head = [F.lit(20242025).cast("bigint").alias("season"), F.lit("2024-10-08T20:30:00Z").alias("startTimeUTC")]
    return documents.select("*", *head, *team, F.lit(LOADED_AT).alias("updated_at"))


_LINES = """
    SELECT l_orderkey AS game_id, CASE l_linestatus WHEN 'F' THEN 'home' ELSE 'away' END AS team_type,
           l_orderkey + CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS team_id,
           'Montreal ' || CASE l_linestatus WHEN 'F' THEN 'home' ELSE 'away' END AS team_name,
           l_partkey AS player_id, 'Player ' || l_partkey AS player_name, l_linenumber AS sweater_number,
           CAST(l_quantity AS BIGINT) AS {value}, l_suppkey AS {other},
           (l_partkey % 60) * 60 + 7 AS time_on_ice_seconds FROM lineitem
"""
_KEPT = ["game_id", "team_type", "team_id", "team_name", "player_id", "player_name", "sweater_number"]


@query(_LINES.format(value="goals", other="shots"))
def skater_flow(t: Source) -> DataFrame:
    """Two lists per side joined, unpacked and named; the third list is not read."""
    return boxscores.skater_game_stats(_boxscores(t)).select(*_KEPT, "goals", "shots", "time_on_ice_seconds")


@query(_LINES.format(value="saves", other="shots_against"))
def goalie_flow(t: Source) -> DataFrame:
    return boxscores.goalie_game_stats(_boxscores(t)).select(*_KEPT, "saves", "shots_against", "time_on_ice_seconds")


def _weeks(t: Source) -> DataFrame:
    """One document per day and week of orders; orders of status P make days without games."""
    kinds = {f.name: f.dataType.simpleString() for f in landed_schema("schedule")["gameWeek"].dataType.elementType["games"].dataType.elementType.fields}
    side = F.struct((F.col("o_custkey") % 7).alias("id"), F.lit("ABC").alias("abbrev"), _named(F.lit("Québec")).alias("placeName"),
                    _named(F.col("o_orderpriority")).alias("commonName"))
    values = {
        "id": F.col("o_orderkey"), "season": F.year("o_orderdate"), "gameType": F.col("o_orderkey") % 4,
        "startTimeUTC": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "venue": _named(F.col("o_orderstatus")),
        "homeTeam": side, "awayTeam": side, "gameScheduleState": F.lit("OK"),
        "gameState": F.when(F.col("o_orderstatus") == "F", F.lit(FINAL_STATE)).otherwise(F.lit("FUT")),
    }
    game = F.struct(*[values[n].cast(k).alias(n) for n, k in kinds.items()])
    day = F.to_date("o_orderdate")
    days = t.orders.groupBy(day.alias("day")).agg(F.collect_list(game).alias("games"))
    entry = F.struct(F.size("games").cast("bigint").alias("numberOfGames"), "games")
    none = F.struct(F.lit(0).cast("bigint").alias("numberOfGames"), F.array().cast(days.schema["games"].dataType).alias("games"))
    weeks = days.groupBy(F.date_trunc("week", "day").alias("week")).agg(F.collect_list(entry).alias("gameWeek"))
    return weeks.select(F.array_append("gameWeek", none).alias("gameWeek"), F.lit(LOADED_AT).alias("updated_at"))


@query(f"""
    SELECT o_orderkey AS game_id, year(o_orderdate) AS season, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_time,
           o_orderkey % 4 AS game_type, o_custkey % 7 AS home_team_id, 'Quebec ' || o_orderpriority AS away_team_name,
           CASE o_orderstatus WHEN 'F' THEN '{FINAL_STATE}' ELSE 'FUT' END AS game_state
    FROM orders WHERE o_orderkey % 4 IN (2, 3) AND NOT (o_orderstatus = 'F' AND o_orderkey % 5 = 0)
""")
def schedule_flow(t: Source) -> DataFrame:
    """Weeks → days → games; a fifth of the finished games is in the table already and stays as it is."""
    loaded = t.orders.where("o_orderkey % 5 = 0").select(
        F.col("o_orderkey").alias("game_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(FINAL_STATE)).otherwise(F.lit("FUT")).alias("game_state"),
    )
    rows = schedule.schedule(_weeks(t), loaded, (2, 3))
    start = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time")
    return rows.select("game_id", "season", start, "game_type", "home_team_id", "away_team_name", "game_state")


@query("SELECT o_orderkey AS game_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 IN (2, 3)")
def finished_keys(t: Source) -> DataFrame:
    return finished_games(_weeks(t), (2, 3))


@query("""
    SELECT CAST(date_trunc('week', o_orderdate) AS DATE)::VARCHAR AS week, count(DISTINCT CAST(o_orderdate AS DATE)) AS days
    FROM orders GROUP BY 1
""")
def array_prefilter(t: Source) -> DataFrame:
    """Days without games leave the document before it is stored."""
    weeks = played_days(_weeks(t))
    week = F.date_trunc("week", utc_second(F.col("gameWeek")[0]["games"][0]["startTimeUTC"]))
    return weeks.select(F.date_format(week, "yyyy-MM-dd").alias("week"), F.size("gameWeek").cast("bigint").alias("days"))


@query("""
    SELECT c_custkey AS player_id, 'Zoe ' || c_name AS player_full_name, '1990-01-' || lpad(CAST(c_nationkey % 28 + 1 AS VARCHAR), 2, '0')
           AS birth_date, c_mktsegment AS birth_city, '2024-01-02 03:04:05' AS updated_at FROM customer
""")
def players_flow(t: Source) -> DataFrame:
    day = F.concat(F.lit("1990-01-"), F.lpad((F.col("c_nationkey") % 28 + 1).cast("string"), 2, "0"))
    values = {"playerId": F.col("c_custkey"), "firstName.default": F.lit("Zoë"), "lastName.default": F.col("c_name"),
              "birthDate": day, "birthCity.default": F.col("c_mktsegment"), "updated_at": F.lit(LOADED_AT)}
    documents = t.customer.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in landed_schema("players").fields]
    )
    return players.players(documents).select(
        "player_id", "player_full_name", F.col("birth_date").cast("string").alias("birth_date"), "birth_city",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


_REGIONS = {"east": tuple(f"T{i}" for i in range(12)), "west": tuple(f"T{i}" for i in range(12, 22))}
_HALVES = {"north": tuple(f"T{i}" for i in range(0, 24, 2)), "south": ("T1", "T3", "T13", "T23")}
_VALUES = [", ".join(f"('{k}', '{x}')" for k, xs in m.items() for x in xs) for m in (_REGIONS, _HALVES)]


def _teams(t: Source) -> DataFrame:
    team = F.struct(F.col("s_suppkey").alias("teamId"), F.concat(F.lit("T"), F.col("s_nationkey").cast("string")).alias("tricode"), _named(F.concat(F.lit("É"), F.col("s_name"))).alias("name"))
    documents = t.supplier.groupBy("s_nationkey").agg(F.collect_list(team).alias("teams"))
    conferences = membership(t.spark, _REGIONS, "conference", "team_abbrev")
    return teams.team_meta(documents.select("teams", F.lit(LOADED_AT).alias("updated_at")), conferences, membership(t.spark, _HALVES, "division", "team_abbrev"))


@query(f"""
    SELECT s_suppkey AS team_id, code AS team_abbrev, 'E' || s_name AS team_name, conference, division
    FROM (SELECT *, 'T' || s_nationkey AS code FROM supplier)
    JOIN (VALUES {_VALUES[0]}) AS c(conference, code) USING (code)
    JOIN (VALUES {_VALUES[1]}) AS d(division, code) USING (code)
""")
def team_meta_flow(t: Source) -> DataFrame:
    """Teams of a document, with two literal lookups; teams that one of them lacks drop."""
    return _teams(t).drop("updated_at")


@query("""
    SELECT n_nationkey AS team_id, n_name AS team_abbrev, c_custkey AS player_id, 'Jose ' || c_name AS player_full_name,
           c_mktsegment AS position FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def rosters_flow(t: Source) -> DataFrame:
    """Three lists of players per team, one of them missing in every second document."""
    kinds = _line(t, "team_rosters", "forwards")
    values = {"id": F.col("c_custkey"), "firstName": _named(F.lit("José")), "lastName": _named(F.col("c_name")),
              "positionCode": F.col("c_mktsegment"), "sweaterNumber": F.lit(9)}
    player = F.struct(*[values[n].cast(k).alias(n) for n, k in kinds.items()])
    group = F.when(F.col("c_custkey") % 2 == 0, 0).when(F.col("c_nationkey") % 2 == 0, 1).otherwise(2)
    lists = [F.collect_list(F.when(group == i, player)).alias(n) for i, n in enumerate(("forwards", "defensemen", "goalies"))]
    stored = t.customer.groupBy("c_nationkey").agg(*lists)
    stored = stored.withColumn("goalies", F.when(F.size("goalies") > 0, F.col("goalies")))
    named = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team_abbrev"))
    documents = stored.join(named, "c_nationkey").select("team_abbrev", "forwards", "defensemen", "goalies", F.lit(LOADED_AT).alias("updated_at"))
    known = t.nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_abbrev"), F.col("n_name").alias("team_name"))
    return teams.team_rosters(documents, known).select("team_id", "team_abbrev", "player_id", "player_full_name", "position")


_STATS = ("sog", "blockedShots", "giveaways", "takeaways", "hits", "pim")


def _stories(t: Source) -> DataFrame:
    """One document per order: each line is a period with one goal, finished lines are the home side's statistics."""
    assist = F.struct(F.col("l_suppkey").alias("playerId"))
    goal = F.struct(
        F.col("l_partkey").alias("playerId"), F.col("l_returnflag").alias("strength"),
        F.concat(F.lpad((F.col("l_suppkey") % 20).cast("string"), 2, "0"), F.lit(":"),
                 F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0")).alias("timeInPeriod"),
        F.col("l_suppkey").alias("homeScore"), F.col("l_linenumber").cast("bigint").alias("awayScore"),
        F.array(assist).alias("assists"), F.lit("?").alias("extra"),
    )
    period = F.struct(F.array(goal).alias("goals"), F.struct(F.col("l_linenumber").alias("number")).alias("periodDescriptor"))
    sums = {}
    for side, status in (("home", "F"), ("away", "O")):
        here = F.col("l_linestatus") == status
        sums[f"{side}_q"] = F.sum(F.when(here, F.col("l_quantity")).otherwise(0)).cast("bigint")
        sums[f"{side}_n"] = F.count(F.when(here, 1))
        sums[f"{side}_r"] = F.count(F.when(here & (F.col("l_returnflag") == "R"), 1))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.to_json(F.collect_list(period)).alias("summary.scoring"), *[c.alias(n) for n, c in sums.items()]
    )

    def stat(category: str, home: Column, away: Column) -> Column:
        return F.struct(F.lit(category).alias("category"), away.cast("string").alias("awayValue"), home.cast("string").alias("homeValue"))

    ratio = [F.concat(F.col(f"{s}_r").cast("string"), F.lit("/"), F.col(f"{s}_n").cast("string")) for s in ("home", "away")]
    stats = F.array(*[stat(c, F.col("home_q") + i, F.col("away_q") + i) for i, c in enumerate(_STATS)],
                    stat("faceoffWinningPctg", F.lit(0.5), F.lit(0.25)), stat("powerPlay", *ratio), stat("powerPlay", ratio[1], ratio[0]))
    star = "struct<star:bigint,playerId:bigint>"
    placed = ((3, F.col("id")), (1, F.col("id") + 1), (2, F.lit(7)))
    stars = F.array(*[F.struct(F.lit(place), player).cast(star) for place, player in placed])
    values = {
        "gameType": F.lit(2), "season": F.lit(20242025), "startTimeUTC": F.lit("2024-10-08T20:30:00Z"),
        "homeTeam.score": F.col("home_n"), "awayTeam.score": F.col("away_n"), "homeTeam.id": F.col("id"), "awayTeam.id": F.col("id") + 1,
        "homeTeam.placeName.default": F.lit("Montréal"), "homeTeam.name.default": F.lit("home"), "awayTeam.name.default": F.lit("away"),
        "periodDescriptor.periodType": F.when(F.col("home_q") > F.col("away_q"), "REG").otherwise("OT"),
        "summary.threeStars": stars, "summary.teamGameStats": stats, "updated_at": F.lit(LOADED_AT),
        "id": F.col("id"), "summary.scoring": F.col("`summary.scoring`"),
    }
    return lines.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in landed_schema("game_story").fields])


@query("""
    WITH g AS (
        SELECT *, CASE WHEN l_linenumber = 5 THEN 3900 ELSE (l_suppkey % 20) * 60 + l_partkey % 60 + (l_linenumber - 1) * 1200 END AS s,
               CASE WHEN l_linenumber = 5 THEN '65:00'
                    WHEN l_linenumber = 1 THEN lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0')
                    ELSE CAST(l_suppkey % 20 + (l_linenumber - 1) * 20 AS VARCHAR) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') END AS c
        FROM lineitem)
    SELECT l_orderkey AS game_id, 'Montreal home' AS home_team_name, 'away' AS away_team_name,
           (l_orderkey + 1) || ',7,' || l_orderkey AS stars,
           string_agg(c, ',' ORDER BY s, c, l_suppkey, l_linenumber, l_returnflag, l_partkey) AS times,
           string_agg(l_partkey, ',' ORDER BY s, c, l_suppkey, l_linenumber, l_returnflag, l_partkey) AS scorers,
           string_agg(l_suppkey, ',' ORDER BY s, c, l_suppkey, l_linenumber, l_returnflag, l_partkey) AS assists
    FROM g GROUP BY l_orderkey
""")
def game_results_flow(t: Source) -> DataFrame:
    """Goals out of JSON text, ordered by the clock of the game, as parallel arrays; the stars by their number."""
    rows = stories.game_results(stories.story_games(_stories(t)))

    def text(array: Column) -> Column:
        return F.array_join(array.cast("array<string>"), ",")

    return rows.select(
        "game_id", "home_team_name", "away_team_name", text(F.col("three_stars_player_ids")).alias("stars"),
        text(F.col("goals_goal_time")).alias("times"), text(F.col("goals_scorer_player_id")).alias("scorers"),
        text(F.flatten("goals_assists_player_ids")).alias("assists"),
    )


@query("""
    WITH s AS (
        SELECT l_orderkey, side, CAST(sum(CASE WHEN l_linestatus = side THEN l_quantity ELSE 0 END) AS BIGINT) AS q,
               count(*) FILTER (WHERE l_linestatus = side) AS n,
               count(*) FILTER (WHERE l_linestatus = side AND l_returnflag = 'R') AS r
        FROM lineitem, (VALUES ('F'), ('O')) v(side) GROUP BY ALL)
    SELECT a.l_orderkey AS game_id, CASE a.side WHEN 'F' THEN 'home' ELSE 'away' END AS team_type, a.n AS score,
           CASE WHEN a.n > b.n THEN 2 WHEN h.q > w.q THEN 0 ELSE 1 END AS points, a.q AS shots_on_goal, b.q AS shots_against,
           a.q + 5 AS penalty_minutes, a.r AS power_play_goals, a.n AS times_power_play, b.n AS times_shorthand, b.n - b.r AS penalty_kill,
           round(CAST(CAST(CASE WHEN b.n = 0 THEN 0 ELSE (b.n - b.r) / b.n END AS FLOAT) AS DOUBLE), 4) AS penalty_kill_pctg
    FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.side <> b.side
    JOIN s h ON h.l_orderkey = a.l_orderkey AND h.side = 'F' JOIN s w ON w.l_orderkey = a.l_orderkey AND w.side = 'O'
""")
def team_game_stats_flow(t: Source) -> DataFrame:
    """Two rows per game; what one side's shots are, the other has against it. Of a repeated category the first counts."""
    rows = stories.team_game_stats(stories.story_games(_stories(t)))
    names = ["game_id", "team_type", "score", "points", "shots_on_goal", "shots_against", "penalty_minutes", "power_play_goals",
             "times_power_play", "times_shorthand", "penalty_kill"]
    return rows.select(*names, F.round(F.col("penalty_kill_pctg").cast("double"), 4).alias("penalty_kill_pctg"))

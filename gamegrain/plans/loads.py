"""Landed feeds → tables: one function per load, each safe to run again."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from gamegrain.operators.gates import expect_distinct
from gamegrain.operators.keys import without
from gamegrain.plans import boxscores, players, schedule, stories, teams
from gamegrain.plans.landing import GAME_BLOCK, SEASON_BLOCK
from gamegrain.session import materialise
from gamegrain.sinks import contracts
from gamegrain.sinks.tables import Table, read_or_empty
from gamegrain.sources import lookups
from gamegrain.sources.feeds import landed_schema
from gamegrain.sources.inventory import file_inventory, latest_snapshot, newest_file
from gamegrain.sources.keyed import keyed_scan
from gamegrain.streaming.arrivals import follow_into
from gamegrain.streaming.increments import reload_due


@dataclass(frozen=True)
class Loads:
    """Loads from the feeds below ``landed`` into the tables below ``tables``."""

    spark: SparkSession
    landed: str
    tables: str

    def table(self, spec: contracts.TableSpec, *spread_by: str) -> Table:
        return Table(self.spark, f"{self.tables}/{spec.name}", spec, spread_by)

    def feed(self, name: str, *extra: str) -> DataFrame:
        schema = landed_schema(name)
        for column in extra:
            schema = schema.add(*column.split(" ", 1))
        return read_or_empty(self.spark, f"{self.landed}/{name}", schema)

    def team_meta(self, now: datetime, max_age_days: int = 1) -> bool:
        """Appends the newest team document unless it is loaded already; tells whether it did."""
        table = self.table(contracts.TEAM_META)
        newest = newest_file(file_inventory(self.spark, f"{self.landed}/team_meta"))
        if not reload_due(newest, table.read(), now, max_age_days):
            return False
        documents = latest_snapshot(self.feed("team_meta", "loaded_on date"), "loaded_on")
        table.append(
            teams.team_meta(documents, lookups.conferences(self.spark), lookups.divisions(self.spark))
        )
        return True

    def team_rosters(self, expected_teams: int = len(lookups.TEAMS)) -> None:
        """Replaces the rosters by the latest snapshot, if the team table is complete."""
        meta = self.table(contracts.TEAM_META).latest()
        expect_distinct(meta, "team_id", expected_teams)
        documents = latest_snapshot(
            self.feed("team_rosters", "team_abbrev string", "snapshot_date date"), "snapshot_date"
        )
        self.table(contracts.TEAM_ROSTERS).replace(teams.team_rosters(documents, meta))

    def schedule(self) -> bool:
        """Appends every game that was not final yet; tells whether there was one."""
        table = self.table(contracts.SCHEDULE)
        rows = schedule.schedule(self.feed("schedule"), table.read())
        if rows.isEmpty():
            return False
        table.append(rows)
        return True

    def players(self) -> None:
        """Appends all player documents; the newest version of a player counts."""
        self.table(contracts.PLAYERS).append(players.players(self.feed("players")))

    def _append_games(self, spec: contracts.TableSpec, feed: str, build) -> bool:
        """Appends the games this one table lacks. The work list takes one column of the feed; documents are then read
        from the blocks of these games only."""
        table = self.table(spec, "game_id")
        stored = self.feed(feed, "block long")
        fresh = without(stored.select("id"), table.keys("game_id").withColumnRenamed("game_id", "id"), "id")
        fresh = materialise(fresh, "fresh-games")
        if fresh.isEmpty():
            return False
        table.append(build(keyed_scan(stored, fresh, "id", GAME_BLOCK, wide_keys=SEASON_BLOCK).drop("block")))
        return True

    def follow_games(self, spec: contracts.TableSpec, feed: str, build, checkpoints: str) -> int:
        """Appends the games of files that came since the last call, and tells how many batches of files there were.

        Files that an earlier call has seen are not opened. A block that was written again brings its games once more;
        those that the table has stay out. A batch that a call stored before it died is not stored again.
        """
        table = self.table(spec, "game_id")

        def fresh(documents: DataFrame) -> DataFrame:
            return build(without(documents, table.keys("game_id").withColumnRenamed("game_id", "id"), "id"))

        schema = landed_schema(feed).add("block", "long")
        return follow_into(table, f"{self.landed}/{feed}", schema, f"{checkpoints}/{spec.name}", fresh, feed)

    def game_stories(self) -> tuple[bool, bool]:
        """Game results and team statistics, each table with its own work list."""
        return (
            self._append_games(
                contracts.GAME_RESULTS, "game_story", lambda new: stories.game_results(stories.story_games(new))
            ),
            self._append_games(
                contracts.TEAM_GAME_STATS, "game_story", lambda new: stories.team_game_stats(stories.story_games(new))
            ),
        )

    def boxscores(self) -> tuple[bool, bool]:
        """Skater and goalie statistics, each table with its own work list."""
        return (
            self._append_games(contracts.SKATER_GAME_STATS, "boxscore", boxscores.skater_game_stats),
            self._append_games(contracts.GOALIE_GAME_STATS, "boxscore", boxscores.goalie_game_stats),
        )

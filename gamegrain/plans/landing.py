"""JSON files → landed document feeds, and the key sets the next steps work on.

The documents arrive as files below ``raw`` (one folder per feed), each holding one document, or one per line with
``multiline=False``. Every step is one Spark job over the files; ids go from step to step as frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamegrain.functions.text import FILE_CODE, FOLDER_VALUE, path_key
from gamegrain.operators.gates import summary, with_content
from gamegrain.operators.keys import any_of, listed_ids, only
from gamegrain.session import materialise
from gamegrain.sinks.documents import overwrite_partitions, put_documents
from gamegrain.sinks.tables import read_or_empty
from gamegrain.sources.feeds import document_schema, landed_schema
from gamegrain.sources.listing import listed_files
from gamegrain.sources.lookups import FINAL_STATE, VALID_GAME_TYPES
from gamegrain.sources.readers import read_json_documents
from gamegrain.streaming.increments import finished_games, new_keys, open_periods, played_days

# Fixed value: the ISO date that starts the name of a weekly schedule file.
FILE_DATE = r"/(\d{4}-\d{2}-\d{2})[^/]*\.json$"
# Fixed value: the game id that starts the name of a file with one document.
FILE_ID = r"/(\d+)[^/]*\.json$"
GAME_FEEDS = ("boxscore", "play_by_play", "game_story")
# Game ids per block, about one load: a night of games writes one block again, not a season. A backfill goes to blocks
# of a season's ids, one folder each.
GAME_BLOCK, SEASON_BLOCK = 100, 10_000


def _path_value(pattern: str) -> Column:
    """Key in the file name, or in the folder of a raw area that is split into ``name=value`` folders."""
    path = F.col("file_path")
    return F.coalesce(path_key(path, pattern), path_key(path, FOLDER_VALUE))


@dataclass(frozen=True)
class Landing:
    """One landing run. ``loaded_at`` (UTC) stamps every document, so a run can be repeated exactly."""

    spark: SparkSession
    raw: str
    out: str
    loaded_at: datetime
    multiline: bool = True
    game_types: Sequence[int] = VALID_GAME_TYPES
    final_state: str = FINAL_STATE

    def _raw(self, feed: str) -> DataFrame:
        return self._stamped(read_json_documents(self.spark, f"{self.raw}/{feed}", feed, self.multiline), feed)

    def _stamped(self, documents: DataFrame | None, feed: str) -> DataFrame:
        if documents is None:
            documents = self.spark.createDataFrame([], document_schema(feed).add("file_path", "string"))
        return documents.withColumn("updated_at", F.lit(self.loaded_at.isoformat()))

    def landed(self, feed: str, *extra: str) -> DataFrame:
        """What is stored of a feed (no rows before the first run)."""
        schema = landed_schema(feed)
        for column in extra:
            schema = schema.add(*column.split(" ", 1))
        return read_or_empty(self.spark, f"{self.out}/{feed}", schema)

    def team_meta(self) -> bool:
        """Load-once: lands the team document unless one is stored; tells whether it did."""
        if not self.landed("team_meta").isEmpty():
            return False
        documents = with_content(self._raw("team_meta").drop("file_path"), "teams")
        overwrite_partitions(documents.withColumn("loaded_on", F.lit(self.loaded_at.date())),
                             f"{self.out}/team_meta", "loaded_on")
        return True

    def team_rosters(self) -> DataFrame:
        """Lands the snapshot of the day, team code from the file name; gives the ids of all rostered players."""
        groups = ("forwards", "defensemen", "goalies")
        documents = with_content(self._raw("team_rosters"), *groups)
        documents = documents.withColumn("team_abbrev", _path_value(FILE_CODE)).drop("file_path")
        day = F.lit(self.loaded_at.date())
        documents = materialise(documents.withColumn("snapshot_date", day), "team-rosters")
        overwrite_partitions(documents, f"{self.out}/team_rosters", "snapshot_date")
        return listed_ids(documents, *[F.col(group).getField("id") for group in groups], name="player_id")

    def schedule(self, periods: DataFrame) -> DataFrame:
        """Lands the weeks that are not closed yet; gives the finished games of all landed weeks that are not stored yet."""
        due = open_periods(periods, self.landed("schedule", "period_start date"), self.loaded_at.date())
        start = _path_value(FILE_DATE).try_cast("date")
        weeks = self._raw("schedule").withColumn("period_start", start).drop("file_path")
        weeks = materialise(played_days(only(weeks, due, "period_start")), "schedule")
        overwrite_partitions(weeks, f"{self.out}/schedule", "period_start")
        finished = finished_games(self.landed("schedule"), self.game_types, self.final_state)
        return new_keys(finished, self.stored_games(), "game_id")

    def stored_games(self) -> DataFrame:
        """Games for which all feeds are stored: a game that failed half-way is fetched again."""
        first, *others = [self.landed(feed).select(F.col("id").alias("game_id")).distinct() for feed in GAME_FEEDS]
        for other in others:
            first = first.join(other, "game_id", "left_semi")
        return first

    def game_feed(self, feed: str, games: DataFrame) -> DataFrame:
        """Lands one feed of the given games and returns the documents."""
        documents = self._raw_of(feed, games, "game_id").drop("file_path")
        documents = materialise(only(documents, games.select(F.col("game_id").alias("id")), "id"), feed)
        put_documents(documents, f"{self.out}/{feed}", "id", "updated_at", GAME_BLOCK, SEASON_BLOCK)
        return documents

    def _raw_of(self, feed: str, keys: DataFrame, key: str) -> DataFrame:
        """Raw documents that may have a wanted key: files with one document each are chosen by their names, listed by
        the executors, and no other file is opened. A file without an id in its name is read.

        The paths of the wanted files pass through the driver, as those of any scan do.
        """
        if not self.multiline:  # many documents in a file, whatever its name
            return self._raw(feed)
        files = listed_files(self.spark, f"{self.raw}/{feed}")
        files = files.withColumn(key, path_key(F.col("path"), FILE_ID).cast("bigint"))
        named = only(files, keys, key).select("path").union(files.where(F.col(key).isNull()).select("path"))
        paths = [row.path for row in named.collect()]
        return self._stamped(read_json_documents(self.spark, paths, feed) if paths else None, feed)

    def play_by_play(self, games: DataFrame) -> DataFrame:
        """Lands the play-by-play documents; gives the ids of the players listed for the games."""
        documents = self.game_feed("play_by_play", games)
        return listed_ids(documents, F.col("rosterSpots").getField("playerId"), name="player_id")

    def players(self, *ids: DataFrame) -> DataFrame:
        """Lands the documents of all players in the id sets; gives the work list."""
        work = materialise(any_of(*ids), "players")
        documents = self._raw_of("players", work, "player_id").drop("file_path")
        wanted = only(documents, work.select(F.col("player_id").alias("playerId")), "playerId")
        put_documents(wanted, f"{self.out}/players", "playerId", "updated_at")
        return work

    def run(self, periods: DataFrame) -> DataFrame:
        """All steps in order; one row with the number of games loaded and players updated."""
        self.team_meta()
        rostered = self.team_rosters()
        games = materialise(self.schedule(periods), "games")
        listed = self.play_by_play(games)
        self.game_feed("boxscore", games)
        self.game_feed("game_story", games)
        players = self.players(rostered, listed)
        return summary(games=games, players=players)

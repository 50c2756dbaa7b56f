"""What a table accepts: columns, ranges, nullability, keys."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Kind:
    """Spark type of a column, and the bounds of the narrower type it has in the target."""

    ddl: str
    low: int | None = None
    high: int | None = None


# The value ranges of the target's number types.
U8 = Kind("smallint", 0, 2**8 - 1)
I8 = Kind("tinyint", -(2**7), 2**7 - 1)
U16 = Kind("int", 0, 2**16 - 1)
U32 = Kind("bigint", 0, 2**32 - 1)
ID = Kind("bigint", 0, 2**63 - 1)
FLOAT, TEXT, FLAG, DAY, TIME = (Kind(name) for name in ("float", "string", "boolean", "date", "timestamp"))
TEXTS, BYTES, IDS, ID_LISTS = (
    Kind(name) for name in ("array<string>", "array<smallint>", "array<bigint>", "array<array<bigint>>")
)


@dataclass(frozen=True)
class TableSpec:
    """A table: columns in order, nullable ones, key (also the order of rows in a file), version column if any."""

    name: str
    columns: dict[str, Kind]
    keys: tuple[str, ...]
    version: str | None = None
    nullable: frozenset[str] = field(default_factory=frozenset)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{name}` {kind.ddl}" for name, kind in self.columns.items()))

    def fits(self) -> Column:
        """True for rows that keep the contract; never NULL."""
        checks = []
        for name, kind in self.columns.items():
            value = F.col(name).try_cast(kind.ddl)
            ok = value.isNotNull()
            if kind.low is not None:
                ok = ok & F.coalesce(value.between(kind.low, kind.high), F.lit(False))
            checks.append(ok | F.col(name).isNull() if name in self.nullable else ok)
        return reduce(and_, checks)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the columns and types of the table; a row that breaks the contract fails the job that writes it."""

    def checked(name: str, kind: Kind) -> Column:
        value = F.col(name).cast(kind.ddl)
        if name not in spec.nullable:
            broken = F.raise_error(F.lit(f"{spec.name}.{name} must not be NULL")).cast(kind.ddl)
            value = F.when(F.col(name).isNull(), broken).otherwise(value)
        if kind.low is not None:
            broken = F.raise_error(F.lit(f"{spec.name}.{name} is out of range")).cast(kind.ddl)
            value = F.when(~F.col(name).cast("bigint").between(kind.low, kind.high), broken).otherwise(value)
        return value.alias(name)

    return df.select(*[checked(name, kind) for name, kind in spec.columns.items()])


def split_by_contract(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows the table takes, in its types; rows it refuses, as they came)."""
    fits = spec.fits()
    taken = df.where(fits).select(*[F.col(name).cast(kind.ddl).alias(name) for name, kind in spec.columns.items()])
    return taken, df.where(~fits)


def _spec(name: str, keys: str, columns: dict[str, Kind], version: str | None = None, nullable: str = "") -> TableSpec:
    return TableSpec(name, columns, tuple(keys.split()), version, frozenset(nullable.split()))


# The columns of the eight tables.
_GAME = {"game_id": ID, "season": U32, "start_time": TIME}
_TEAM = {"team_id": U32, "team_abbrev": TEXT, "team_name": TEXT}
_SIDE = {f"{side}_team_{name}": kind for side in ("home", "away")
         for name, kind in (("id", U32), ("abbrev", TEXT), ("name", TEXT))}
_LINE = {**_GAME, "team_type": TEXT, **_TEAM,
         "player_id": U32, "player_name": TEXT, "position": TEXT, "sweater_number": U8}

TEAM_META = _spec(
    "team_meta", "team_id", {**_TEAM, "conference": TEXT, "division": TEXT, "updated_at": TIME}, "updated_at"
)
TEAM_ROSTERS = _spec(
    "team_rosters",
    "team_id player_id",
    {**_TEAM, "player_id": U32, "player_full_name": TEXT, "position": TEXT, "sweater_number": U8, "updated_at": TIME},
)
SCHEDULE = _spec(
    "schedule",
    "game_id",
    {**_GAME, "game_type": U8, "venue": TEXT, **_SIDE,
     "game_state": TEXT, "game_schedule_state": TEXT, "updated_at": TIME},
    "updated_at",
)
PLAYERS = _spec(
    "players",
    "player_id",
    {"player_id": U32, "is_active": FLAG, "player_full_name": TEXT, "birth_date": DAY, "birth_city": TEXT,
     "birth_country": TEXT, "height_cm": U8, "weight_kg": U8, "headshot_img": TEXT, "hero_img": TEXT,
     "position": TEXT, "sweater_number": U8, "shoots_catches": TEXT, "current_team_id": U32,
     "current_team_abbrev": TEXT, "current_team_name": TEXT, "updated_at": TIME},
    "updated_at",
    nullable="sweater_number current_team_id current_team_abbrev current_team_name",
)
GAME_RESULTS = _spec(
    "game_results",
    "game_id",
    {**_GAME, "period_type": TEXT, "home_team_score": U8, "away_team_score": U8, **_SIDE,
     "three_stars_player_ids": IDS, "goals_goal_time": TEXTS, "goals_home_score": BYTES, "goals_away_score": BYTES,
     "goals_strength": TEXTS, "goals_scorer_player_id": IDS, "goals_assists_player_ids": ID_LISTS,
     "updated_at": TIME},
)
TEAM_GAME_STATS = _spec(
    "team_game_stats",
    "game_id team_id",
    {**_GAME, "team_type": TEXT, **_TEAM, "score": U8, "points": U8, "period_type": TEXT, "shots_on_goal": U8,
     "shots_against": U8, "blocked_shots": U8, "faceoff_winning_pctg": FLOAT, "giveaways": U8, "takeaways": U8,
     "hits": U8, "penalty_minutes": U16, "power_play_goals": U8, "times_power_play": U8, "power_play_pctg": FLOAT,
     "penalty_kill": U8, "times_shorthand": U8, "penalty_kill_pctg": FLOAT, "updated_at": TIME},
)
SKATER_GAME_STATS = _spec(
    "skater_game_stats",
    "game_id player_id",
    {**_LINE, "goals": U8, "assists": U8, "points": U8, "plus_minus": I8, "penalty_minutes": U16,
     "power_play_goals": U8, "shots": U8, "hits": U8, "blocked_shots": U8, "faceoff_winning_pctg": FLOAT,
     "giveaways": U8, "takeaways": U8, "shifts": U8, "time_on_ice": TEXT, "time_on_ice_seconds": U16,
     "updated_at": TIME},
)
GOALIE_GAME_STATS = _spec(
    "goalie_game_stats",
    "game_id player_id",
    {**_LINE, "starter": FLAG, "decision": TEXT, "saves": U8, "shots_against": U8, "save_pctg": FLOAT,
     "goals_against": U8, "penalty_minutes": U16, "time_on_ice": TEXT, "time_on_ice_seconds": U16,
     "updated_at": TIME},
    nullable="decision save_pctg",
)
TABLES = {
    spec.name: spec
    for spec in (TEAM_META, TEAM_ROSTERS, SCHEDULE, PLAYERS, GAME_RESULTS, TEAM_GAME_STATS, SKATER_GAME_STATS,
                 GOALIE_GAME_STATS)
}

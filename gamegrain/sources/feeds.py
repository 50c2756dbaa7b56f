"""Schemas of the document feeds, as they lie on storage: dotted names are literal column names.

Only the fields the jobs use are declared, so a scan reads no other column, nested ones included.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the documents.
_NAME = "struct<default:string>"
_TEAM = f"struct<id:bigint,abbrev:string,placeName:{_NAME},commonName:{_NAME}>"
_GAME = (
    f"struct<id:bigint,season:bigint,gameType:bigint,startTimeUTC:string,venue:{_NAME},"
    f"homeTeam:{_TEAM},awayTeam:{_TEAM},gameState:string,gameScheduleState:string>"
)
_ROSTER_PLAYER = f"struct<id:bigint,firstName:{_NAME},lastName:{_NAME},positionCode:string,sweaterNumber:bigint>"
_SKATER = (
    f"struct<playerId:bigint,name:{_NAME},position:string,sweaterNumber:bigint,goals:bigint,assists:bigint,"
    "points:bigint,plusMinus:bigint,pim:bigint,powerPlayGoals:bigint,sog:bigint,hits:bigint,blockedShots:bigint,"
    "faceoffWinningPctg:double,giveaways:bigint,takeaways:bigint,shifts:bigint,toi:string>"
)
_GOALIE = (
    f"struct<playerId:bigint,name:{_NAME},position:string,sweaterNumber:bigint,starter:boolean,decision:string,"
    "saves:bigint,shotsAgainst:bigint,savePctg:double,goalsAgainst:bigint,pim:bigint,toi:string>"
)
_PERSON = f"playerId:bigint,firstName:{_NAME},lastName:{_NAME}"
SCORING = (
    f"array<struct<goals:array<struct<{_PERSON},strength:string,timeInPeriod:string,homeScore:bigint,"
    f"awayScore:bigint,assists:array<struct<{_PERSON}>>>>,periodDescriptor:struct<number:bigint>>>"
)

_FIELDS = {
    "team_meta": [("teams", f"array<struct<teamId:bigint,tricode:string,name:{_NAME}>>")],
    "team_rosters": [(group, f"array<{_ROSTER_PLAYER}>") for group in ("forwards", "defensemen", "goalies")],
    "schedule": [("gameWeek", f"array<struct<numberOfGames:bigint,games:array<{_GAME}>>>")],
    "boxscore": [
        ("id", "bigint"),
        ("season", "bigint"),
        ("startTimeUTC", "string"),
        *[
            (f"{side}Team.{name}", kind)
            for side in ("home", "away")
            for name, kind in [
                ("id", "bigint"),
                ("abbrev", "string"),
                ("placeName.default", "string"),
                ("commonName.default", "string"),
            ]
        ],
        *[
            (f"playerByGameStats.{side}Team.{group}", f"array<{_GOALIE if group == 'goalies' else _SKATER}>")
            for side in ("home", "away")
            for group in ("forwards", "defense", "goalies")
        ],
    ],
    "game_story": [
        ("id", "bigint"),
        ("season", "bigint"),
        ("gameType", "bigint"),
        ("startTimeUTC", "string"),
        ("gameState", "string"),
        ("gameScheduleState", "string"),
        *[
            (f"{side}Team.{name}", kind)
            for side in ("home", "away")
            for name, kind in [
                ("id", "bigint"),
                ("abbrev", "string"),
                ("placeName.default", "string"),
                ("name.default", "string"),
                ("score", "bigint"),
            ]
        ],
        ("periodDescriptor.periodType", "string"),
        ("summary.threeStars", "array<struct<star:bigint,playerId:bigint>>"),
        ("summary.teamGameStats", "array<struct<category:string,awayValue:string,homeValue:string>>"),
        # JSON text: its structure drifts between games, so it is parsed late (``SCORING``).
        ("summary.scoring", "string"),
    ],
    "play_by_play": [("id", "bigint"), ("rosterSpots", "array<struct<playerId:bigint>>")],
    "players": [
        ("playerId", "bigint"),
        ("isActive", "boolean"),
        ("firstName.default", "string"),
        ("lastName.default", "string"),
        ("birthDate", "string"),
        ("birthCity.default", "string"),
        ("birthCountry", "string"),
        ("heightInCentimeters", "bigint"),
        ("weightInKilograms", "bigint"),
        ("headshot", "string"),
        ("heroImage", "string"),
        ("position", "string"),
        ("sweaterNumber", "bigint"),
        ("shootsCatches", "string"),
        ("currentTeamId", "bigint"),
        ("currentTeamAbbrev", "string"),
        ("fullTeamName.default", "string"),
    ],
}

FEEDS = tuple(_FIELDS)


def document_schema(feed: str) -> T.StructType:
    """Flat schema of a feed as the source delivers it (before landing)."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in _FIELDS[feed]))


def landed_schema(feed: str) -> T.StructType:
    """Flat schema of a landed feed: the document plus its load time stamp (ISO-8601 text)."""
    return document_schema(feed).add("updated_at", "string")

"""Player documents → ``players``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.functions.clocks import to_day, utc_second
from gamegrain.functions.text import fold_ascii, full_name

# Dotted document columns and the plain names they get.
PLAIN_NAMES = {
    "playerId": "player_id",
    "isActive": "is_active",
    "firstName.default": "first_name",
    "lastName.default": "last_name",
    "birthDate": "birth_date",
    "birthCity.default": "birth_city",
    "birthCountry": "birth_country",
    "heightInCentimeters": "height_cm",
    "weightInKilograms": "weight_kg",
    "headshot": "headshot_img",
    "heroImage": "hero_img",
    "sweaterNumber": "sweater_number",
    "shootsCatches": "shoots_catches",
    "currentTeamId": "current_team_id",
    "currentTeamAbbrev": "current_team_abbrev",
    "fullTeamName.default": "current_team_name",
}


def players(documents: DataFrame) -> DataFrame:
    """One row per player document, names folded to ASCII."""
    plain = documents.withColumnsRenamed(PLAIN_NAMES)
    return plain.withColumns(
        {
            "player_full_name": fold_ascii(full_name("first_name", "last_name")),
            "birth_date": to_day(F.col("birth_date")),
            "birth_city": fold_ascii(F.col("birth_city")),
            "current_team_name": fold_ascii(F.col("current_team_name")),
            "updated_at": utc_second(F.col("updated_at")),
        }
    ).drop("first_name", "last_name")

"""Text keys and the parsing of run-together source cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions.numeric import to_number

# Layouts of a combined player and team cell, first match wins.
PLAYER_TEAM_LAYOUTS = (
    r"^(.+?)([A-Z]{2,3})highlow$",
    r"^(.*?)([A-Z]{2,3})\(\d+\)$",
    r"^(.*?)\s+\(([A-Z]{2,3})\)$",
    r"^(.*?)\s+([A-Z]{2,3})\s+\(\d+\)$",
)
PARENTHESISED = r"\s*\(.*?\)"
MARKET_TEXT = r"^(.*?)\s+[A-Z]{2,3}\s+\(\d+\)$"
ONE_DECIMAL = r"-?\d+\.\d"
ANY_NUMBER = r"-?\d+(?:\.\d+)?"
# Team codes used to settle where a name ends and a team begins.
TEAM_CODES = (
    "ARI", "ATL", "BAL", "BUF", "CAR", "CHI", "CIN", "CLE", "DAL", "DEN", "DET", "FA", "GB", "HOU", "IND", "JAC",
    "JAX", "KC", "LA", "LAC", "LAR", "LV", "MIA", "MIN", "NE", "NO", "NYG", "NYJ", "OAK", "PHI", "PIT", "SD", "SEA",
    "SF", "STL", "TB", "TEN", "WAS", "WSH",
)


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def entity_key(name: Column) -> Column:
    """Lower-cased letters of a name."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z]", "")


def clean_position(pos: Column) -> Column:
    """Upper-cased position without its rank digits."""
    return F.regexp_replace(F.upper(F.coalesce(pos, F.lit(""))), "[0-9]", "")


def split_player_team(value: Column, teams: Sequence[str] | None = TEAM_CODES) -> Column:
    """Struct (player, team) out of a combined cell.

    ``teams`` lists the valid codes: in the two layouts that run name and team together the longest
    valid code wins, so "Kenneth Walker IIKC(5)" gives team KC. ``teams=None`` takes the letters as
    the bare layouts cut them.
    """
    text = strip(value.cast("string"))

    def parts(name: Column, team: Column) -> Column:
        return F.struct(strip(name).alias("player"), strip(team).alias("team"))

    found = None
    for at, layout in enumerate(PLAYER_TEAM_LAYOUTS):
        if teams is not None and at < 2:
            for width in (3, 2):
                codes = "|".join(sorted(code for code in teams if len(code) == width))
                exact = layout.replace("[A-Z]{2,3}", codes)
                hit = (text.rlike(exact), parts(F.regexp_extract(text, exact, 1), F.regexp_extract(text, exact, 2)))
                found = F.when(*hit) if found is None else found.when(*hit)
        hit = (text.rlike(layout), parts(F.regexp_extract(text, layout, 1), F.regexp_extract(text, layout, 2)))
        found = F.when(*hit) if found is None else found.when(*hit)
    return found.otherwise(parts(F.regexp_replace(text, PARENTHESISED, ""), F.lit("")))


def split_high_low(value: Column) -> Column:
    """Array of up to three numbers (main, high, low) out of a run-together cell."""
    text = F.replace(value.cast("string"), F.lit(","), F.lit(""))
    single = F.regexp_extract_all(text, F.lit(ONE_DECIMAL), 0)
    general = F.regexp_extract_all(text, F.lit(ANY_NUMBER), 0)
    hits = F.when(F.size(single) > 0, single).otherwise(general)
    return F.transform(F.slice(hits, 1, 3), lambda n: n.try_cast("double"))


def market_name(text: Column) -> Column:
    """Name part of "Name TEAM (bye)", or the whole text when it has another layout."""
    return F.when(text.rlike(MARKET_TEXT), F.regexp_extract(text, MARKET_TEXT, 1)).otherwise(text)


def row_id(*parts: Column) -> Column:
    return F.concat_ws("-", *parts)


def position_label(rank: Column, pos: Column) -> Column:
    return F.concat(rank.cast("string"), pos)


def entity_tokens(spark, query: str, letters_only: bool = True) -> DataFrame:
    """Rows (token, name, key, start) of a query such as "Josh Allen, Travis Kelce:2020".

    ``letters_only=False`` takes the name itself as the key, for entities with other ids.
    """
    key = entity_key(F.col("name")) if letters_only else F.col("name")
    pieces = spark.range(1).select(F.posexplode(F.split(F.lit(query), ",")).alias("token", "piece"))
    parts = F.split("piece", ":")
    return (
        pieces.filter(F.trim("piece") != "")
        .select("token", F.trim(parts[0]).alias("name"), F.trim(F.try_element_at(parts, F.lit(2))).alias("since"))
        .select("token", "name", key.alias("key"), to_number(F.col("since")).alias("start"))
    )

"""From parsed stat tables to the projection, market and weekly tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.functions.numeric import to_number
from waterline.functions.text import TEAM_CODES, split_high_low, split_player_team

# Target names by position. Each rule is (header test, names by occurrence); repeats of
# the last name cover further occurrences.
_TD = r"TDS|^TD(_\d+)?$"
RENAME_RULES: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "QB": (
        (r"ATT", ("PassingATT", "RushingATT")),
        (r"CMP", ("PassingCMP",)),
        (r"YDS", ("PassingYDS", "RushingYDS")),
        (_TD, ("PassingTD", "RushingTD")),
        (r"INT", ("INTS",)),
        (r"FL", ("FL",)),
    ),
    "RB": (
        (r"ATT", ("RushingATT",)),
        (r"REC", ("REC",)),
        (r"YDS", ("RushingYDS", "ReceivingYDS")),
        (_TD, ("RushingTD", "ReceivingTD")),
        (r"FL", ("FL",)),
    ),
    "WR": (
        (r"REC", ("REC",)),
        (r"ATT", ("RushingATT",)),
        (r"YDS", ("ReceivingYDS", "RushingYDS")),
        (_TD, ("ReceivingTD", "RushingTD")),
        (r"FL", ("FL",)),
    ),
}
RENAME_RULES["TE"] = RENAME_RULES["WR"]
EXCLUDED_PLAYERS = ("Taysom Hill",)
KEY_COLUMNS = ("Player", "Team", "Pos")


def rename_map(pos: str, columns: Iterable[str]) -> dict[str, str]:
    """Canonical stat names for a position's headers, by substring and order of occurrence."""
    seen: dict[str, int] = {}
    renames: dict[str, str] = {}
    for column in columns:
        if column in KEY_COLUMNS:
            continue
        for test, names in RENAME_RULES[pos.upper()]:
            if re.search(test, column.upper()):
                at = seen.get(test, 0)
                seen[test] = at + 1
                renames[column] = names[min(at, len(names) - 1)]
                break
    return renames


def _split_players(df: DataFrame, column: str, teams: Sequence[str] | None) -> DataFrame:
    parts = split_player_team(F.col(f"`{column}`"), teams)
    return df.withColumn("_parts", parts).withColumns(
        {"Player": F.col("_parts.player"), "Team": F.col("_parts.team")}
    ).drop("_parts")


def position_projections(
    df: DataFrame, pos: str, teams: Sequence[str] | None = TEAM_CODES, keys: Sequence[str] = ()
) -> DataFrame:
    """One position's projection page: split names, canonical headers, each stat as main/High/Low.

    ``keys`` are columns that tell where a row comes from, as of its page; they are passed through and are no stats.
    """
    split = _split_players(df, "Player", teams)
    named = split.withColumnsRenamed(rename_map(pos, [c for c in split.columns if c not in keys]))
    stats = [c for c in named.columns if c not in ("Player", "Team", *keys)]
    parsed = named.select("Player", "Team", *keys, *[split_high_low(F.col(f"`{c}`")).alias(c) for c in stats])
    columns: list[Column] = [F.col("Player"), F.col("Team"), F.lit(pos.upper()).alias("Pos"), *[F.col(k) for k in keys]]
    for stat in stats:
        for at, suffix in enumerate(("", " High", " Low"), start=1):
            columns.append(F.try_element_at(F.col(f"`{stat}`"), F.lit(at)).alias(stat + suffix))
    return parsed.select(*columns)


def union_positions(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables whose columns differ by position; absent columns are NULL."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def current_projections(
    pages: dict[str, DataFrame],
    year: int,
    excluded: Sequence[str] = EXCLUDED_PLAYERS,
    teams: Sequence[str] | None = TEAM_CODES,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All positions' projections for a season, without the excluded players."""
    stacked = union_positions([position_projections(df, pos, teams, keys) for pos, df in pages.items()])
    kept = stacked.filter(~F.col("Player").isin(*excluded)) if excluded else stacked
    return kept.select(F.lit(year).alias("Year"), "*")


def market_columns(columns: Sequence[str]) -> tuple[str, str | None, str | None]:
    """Headers that hold the player text, the rank and the average draft position."""
    spare = columns[1] if len(columns) > 1 else columns[0]
    player = next((c for c in columns if "player" in c.lower().replace(" ", "")), spare)
    rank = next((c for c in columns if c.lower() == "rank"), None)
    average = next((c for c in columns if c.lower() in ("avg", "adp")), None)
    return player, rank, average


def market_table(df: DataFrame, year: int, teams: Sequence[str] | None = TEAM_CODES) -> DataFrame:
    """The six market columns; a source without rank, average or position gives NULL or blank."""
    player, rank, average = market_columns(df.columns)
    missing = F.lit(None).cast("double")

    def number(name: str | None) -> Column:
        return missing if name is None else to_number(F.col(f"`{name}`").cast("string"))

    parts = split_player_team(F.col(f"`{player}`"), teams)
    return df.select(
        F.lit(year).alias("Year"),
        parts["player"].alias("Player"),
        parts["team"].alias("Team"),
        number(rank).alias("ADP Rank"),
        (F.col("POS") if "POS" in df.columns else F.lit("")).alias("POS"),
        number(average).alias("ADP"),
    )


def weekly_table(df: DataFrame, pos: str, year: Column | int, week: Column | int,
                 teams: Sequence[str] | None = TEAM_CODES, keys: Sequence[str] = ()) -> DataFrame:
    """Weekly stat rows of one position: split names, constant keys, canonical numeric stats; ``keys`` are passed through."""
    split = _split_players(df, "Player", teams)
    stats = [c for c in split.columns if c not in ("Player", "Team", "Year", "Week", "Pos", *keys)]
    renames = rename_map(pos, stats)
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return split.select(
        "Player",
        "Team",
        F.lit(pos.upper()).alias("Pos"),
        as_column(year).cast("int").alias("Year"),
        as_column(week).cast("int").alias("Week"),
        *keys,
        *[to_number(F.col(f"`{c}`").cast("string")).alias(renames.get(c, c)) for c in stats],
    )

"""Tables and series read by reports: result table, summary, curves, trends and season cards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.config import POSITIONS, TABLE_ROWS
from waterline.functions.numeric import rank_key
from waterline.operators.ranking import number_rows, shuffle_width
from waterline.operators.season import full_curve
from waterline.sources.storage import materialise, small

# Metrics a season trend can show.
SEASON_METRICS = ("war", "fpts", "avg", "flex_war", "superflex_war")
DEFAULT_TREND_ENTITIES = 6
#: Text order of reports: letters first, then accents, then case, by the Unicode root locale.
TEXT_ORDER = "UNICODE"
#: Rows of a row group of seasons stored by entity.
ENTITY_ROW_GROUP = 20_000


def visible(results: DataFrame, positions: Sequence[str] = POSITIONS, search: str = "") -> DataFrame:
    """Rows of the chosen positions whose "player team" text contains the search text."""
    rows = results.filter(F.col("pos").isin(*positions))
    wanted = search.strip().lower()
    if not wanted:
        return rows
    return rows.filter(F.lower(F.concat_ws(" ", "player", F.coalesce("team", F.lit("")))).contains(wanted))


def sort_columns(df: DataFrame, key: str, descending: bool = False, collation: str | None = TEXT_ORDER) -> list[Column]:
    """Ordering by any column: missing numbers count as +infinity, missing text as blank.

    Text goes by ``collation``, also where the columns make a range layout; None compares code points.
    """
    if isinstance(df.schema[key].dataType, T.StringType):
        text = F.coalesce(F.col(key), F.lit(""))
        text = F.collate(text, collation) if collation else text
        return [text.desc() if descending else text.asc()]
    return [F.col(key).desc_nulls_first() if descending else F.col(key).asc_nulls_last()]


def result_table(
    results: DataFrame,
    positions: Sequence[str] = POSITIONS,
    search: str = "",
    sort: str = "overall_rank",
    descending: bool = False,
    rows: int = TABLE_ROWS,
    collation: str | None = TEXT_ORDER,
) -> DataFrame:
    """The first rows of the visible results in the chosen order."""
    shown = visible(results, positions, search)
    return shown.orderBy(*sort_columns(shown, sort, descending, collation), F.col("overall_rank").asc()).limit(rows)


def place_rows(
    rows: DataFrame, sort: str, ties: Sequence[str], descending: bool = False, out: str = "place", collation: str | None = TEXT_ORDER
) -> DataFrame:
    """All rows with their place in the chosen order, for tables of any length; ``ties`` make the order total."""
    return number_rows(rows, [*sort_columns(rows, sort, descending, collation), *[F.col(t).asc() for t in ties]], out)


def summary(results: DataFrame, env: DataFrame) -> DataFrame:
    """One row: count, best by WAR, best by value, replacement level per position and team source."""
    by_war = F.struct(rank_key(F.col("war")), -F.col("overall_rank"))
    by_value = F.when(F.col("value").isNotNull(), F.struct(rank_key(F.col("value")), -F.col("overall_rank")))
    totals = results.agg(
        F.count(F.lit(1)).alias("player_count"),
        F.max_by(F.struct("player", "war"), by_war).alias("top_war"),
        F.max_by(F.struct("player", "value"), by_value).alias("top_value"),
    )
    levels = env.select(*[F.col(p)["replacement"].alias(p) for p in POSITIONS], "source")
    return totals.select(
        "player_count",
        F.col("top_war.player").alias("top_war_player"),
        F.col("top_war.war").alias("top_war"),
        F.col("top_value.player").alias("top_value_player"),
        F.col("top_value.value").alias("top_value"),
        *[levels.select(p).scalar().alias(f"{p.lower()}_replacement") for p in POSITIONS],
        levels.select("source").scalar().alias("team_source"),
    )


def metric_against_market(results: DataFrame, metric: str) -> DataFrame:
    """Points (metric, market position); WAR stands in for a metric that no row has."""
    filled = results.agg(F.count(metric).alias("n"))
    return results.select(
        "pos",
        "player",
        F.when(filled.scalar() > 0, F.col(metric)).otherwise(F.col("war")).alias("x"),
        F.coalesce(F.col("adp"), F.col("overall_rank").cast("double")).alias("y"),
    )


def curve_series(curve: DataFrame, positions: Sequence[str] = POSITIONS) -> DataFrame:
    """Curve points at every rank of the chosen positions."""
    return full_curve(curve).filter(F.col("pos").isin(*positions)).orderBy("pos", "rank")


def between_years(seasons: DataFrame, first: int, last: int) -> DataFrame:
    return seasons.filter(F.col("year").between(first, last))


def long_metrics(seasons: DataFrame, keys: Sequence[str], metrics: Sequence[str] = SEASON_METRICS) -> DataFrame:
    """One row per season and metric."""
    return seasons.unpivot(list(keys), list(metrics), "metric", "value")


def rank_trend(
    top: DataFrame, rank: int, metrics: Sequence[str], first: int, last: int, positions: Sequence[str] = POSITIONS
) -> DataFrame:
    """Metric of the season at ``rank``, by position and year. ``top`` needs ranks up to ``rank`` only."""
    chosen = between_years(top, first, last).filter((F.col("rank") == rank) & F.col("pos").isin(*positions))
    return long_metrics(chosen, ["pos", "year", "player"], metrics).orderBy("pos", "metric", "year")


def token_seasons(seasons: DataFrame, tokens: DataFrame) -> DataFrame:
    """Seasons of each token's entity from the token's start year on, in any position.

    The tokens come from one line of user input, so they are the broadcast side.
    """
    t = tokens.select("token", F.col("key").alias("_key"), F.col("start").alias("_start"))
    since = F.col("_start").isNull() | (F.col("_start") == 0) | (F.col("year") >= F.col("_start"))
    matched = seasons.join(small(t, tokens.count()), (F.col("player_key") == F.col("_key")) & since)
    return matched.drop("_key", "_start").withColumnRenamed("token", "series")


def default_seasons(seasons: DataFrame, entities: int = DEFAULT_TREND_ENTITIES) -> DataFrame:
    """All seasons of the latest season's best entities, told apart by key and position.

    The seasons are written once, so that the facts behind them are read once: the latest season, its best and their
    other seasons all come from the written table.
    """
    stored = materialise(seasons)
    latest = stored.agg(F.max("year")).first()[0]
    best = (
        stored.filter(F.col("year") == F.lit(latest))
        .orderBy(rank_key(F.col("war")).desc(), "player", "team")
        .limit(entities)
        .select("player_key", "pos")
    )
    return stored.join(small(best, entities), ["player_key", "pos"], "left_semi")


def entity_trend(
    chosen: DataFrame, series: Sequence[str], metric: str, aligned: bool = False, series_bound: int | None = None
) -> DataFrame:
    """Metric by year, or by each series' own season index when ``aligned``.

    A short name key may match very many seasons, so the index is numbered without a window per
    series. ``series_bound`` is the most series there can be.
    """
    keep = list(dict.fromkeys([*series, "player", "team", "pos", "year"]))
    if aligned:
        order = [F.col("year").asc(), F.col("player").asc(), F.col("team").asc(), F.col("pos").asc()]
        chosen = number_rows(chosen.select(*keep, metric), order, "x", within=list(series), groups=series_bound)
    else:
        chosen = chosen.withColumn("x", F.col("year"))
    return chosen.select(*keep, "x", F.col(metric).alias("y"))


def entity_history(seasons: DataFrame, chosen: DataFrame, chosen_rows: int) -> DataFrame:
    """Chosen entities' own seasons in their position, newest first; ``chosen_rows`` bounds the choice."""
    own = seasons.join(small(chosen.select("player_key", "pos"), chosen_rows), ["player_key", "pos"])
    return own.orderBy("player_key", "pos", F.col("year").desc(), "team")


def store_by_entity(seasons: DataFrame, path: str, row_group: int = ENTITY_ROW_GROUP) -> None:
    """Write seasons for look-ups of single entities: files by range of ``player_key``, sorted, with Bloom filters of it.

    A reader that knows the keys skips files and row groups by their least and greatest key, and those that the Bloom
    filter rules out, so a look-up reads a few row groups of ``row_group`` rows and not the table.
    """
    laid = seasons.repartitionByRange(shuffle_width(seasons), "player_key", "pos").sortWithinPartitions("player_key", "pos", "year")
    writer = laid.write.mode("overwrite").option("parquet.bloom.filter.enabled#player_key", "true")
    writer.option("parquet.bloom.filter.expected.ndv#player_key", row_group).option("parquet.block.row.count.limit", row_group).parquet(path)


def stored_history(spark, path: str, entities: Sequence[tuple[str, str]]) -> DataFrame:
    """``entity_history`` of the (player_key, pos) ``entities`` from a table of ``store_by_entity``; the keys reach the file reader.

    The entities are a user's choice, some at most: each key is a condition of its own, so that it skips by itself.
    """
    wanted = [(F.col("player_key") == key) & (F.col("pos") == pos) for key, pos in dict.fromkeys(entities)]
    rows = spark.read.parquet(path)
    own = rows.filter(reduce(Column.__or__, wanted)) if wanted else rows.limit(0)
    return own.orderBy("player_key", "pos", F.col("year").desc(), "team")


def newest_season(history: DataFrame) -> DataFrame:
    """Each entity's newest season (the first team by name when it has two)."""
    newest = Window.partitionBy("player_key", "pos").orderBy(F.col("year").desc(), F.col("team").asc())
    return history.withColumn("_at", F.row_number().over(newest)).filter("_at = 1").drop("_at")


def week_grid(seasons: DataFrame, weeks: int, keys: Sequence[str] = ("player_key", "pos", "year", "team")) -> DataFrame:
    """Two rows per season (WAR and FPTS) with a column per week, NULL where no game was played.

    A season's weeks sit in one short array, so the grid is read off it without a shuffle.
    """
    by_week = F.map_from_entries(F.transform("weeks", lambda w: F.struct(w["week"], w)))
    grid = seasons.withColumn("_week", by_week)

    def cells(field: str) -> list[Column]:
        return [F.try_element_at("_week", F.lit(w))[field].alias(f"w{w}") for w in range(1, weeks + 1)]

    rows = F.array(*[F.struct(F.lit(f).alias("metric"), *cells(f)) for f in ("war", "fpts")])
    return grid.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


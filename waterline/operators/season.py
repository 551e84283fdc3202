"""Weekly facts to season values, ranks and the rank curve."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.config import MAX_CURVE_RANK, POSITIONS, SCORING, LeagueConfig, Scenarios, ScoringWeights
from waterline.functions.numeric import rank_key
from waterline.functions.scoring import fantasy_points
from waterline.functions.text import entity_key, row_id
from waterline.operators.model import value_scores, yardsticks
from waterline.operators.pools import within_scenario
from waterline.operators.ranking import best_rows, number_rows, shuffle_width
from waterline.schema import Fields
from waterline.sources.storage import materialise

SEASON = ("year", "player", "team", "pos")
REPEATED = "a season holds a week twice; name the columns of the input order"
TIES = ("player", "team", "player_key")


def _typed(weekly: DataFrame, key: str | None, carry: Sequence[str], points: Callable[[Fields, Column], Column]) -> DataFrame:
    row = Fields(weekly)
    pos = F.upper(F.coalesce(row.text("pos"), F.lit("")))
    player = row.text("player", "")
    entity = entity_key(player) if key is None else F.col(key).cast("string")
    return weekly.select(
        row_id(entity, pos).alias("id"),
        entity.alias("player_key"),
        player.alias("player"),
        row.text("team", "").alias("team"),
        pos.alias("pos"),
        row.whole("year").alias("year"),
        row.whole("week").alias("week"),
        points(row, pos),
        *carry,
    )


def score_weekly(
    weekly: DataFrame, weights: ScoringWeights, key: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Typed facts (id, player, team, pos, year, week, fpts) re-scored under ``weights``.

    ``key`` names the entity column; the default is the letters of the player's name. Points are
    rounded to nine places, so equal scores stay equal whatever order their stats were summed in.
    """
    return _typed(weekly, key, carry, lambda row, pos: rank_key(fantasy_points(row, pos, weights)).alias("fpts"))


def score_weekly_each(
    weekly: DataFrame, scenarios: Scenarios, key: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """As ``score_weekly`` under every distinct scoring of ``scenarios`` in one pass: a row each, with ``scoring`` its number.

    A fact carries its points as a short array, which is read off without a shuffle; the facts are scanned once
    however many scorings there are. Without ``carry`` a season holds a week once, so no key is hot and the facts are laid
    out by season first, in as many tasks as the session shuffles into: a sweep makes many rows of each fact, and neither
    the sort for its heads nor the sums of its seasons should hold those of a part as large as the engine likes to merge.
    The sums then need no exchange of their own.
    """

    def points(row: Fields, pos: Column) -> Column:
        found = [rank_key(fantasy_points(row, pos, w)).alias("fpts") for w in scenarios.scorings]
        return F.array(*[F.struct(F.lit(k).alias(SCORING), p) for k, p in enumerate(found)]).alias("_points")

    typed = _typed(weekly, key, carry, points)
    if not carry:
        typed = typed.repartition(shuffle_width(weekly), *SEASON, "player_key")
    return typed.select(*[c for c in typed.columns if c != "_points"], F.inline("_points"))


def eligible(scored: DataFrame, league: LeagueConfig | Scenarios) -> DataFrame:
    """Rows that count: named entity, one of the four positions, season and week in range, a score.

    A season has no upper bound. Rows without a whole week or year have none and do not count.
    """
    scenarios = Scenarios.of(league)
    return scored.filter(
        (F.col("player") != "")
        & F.col("pos").isin(*POSITIONS)
        & (F.col("year") >= scenarios.lowest(lambda c: c.start_year))
        & F.col("week").between(1, scenarios.highest(lambda c: c.weeks))
        & F.col("fpts").isNotNull()
    )


def last_rows(scored: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per season and week, the last in input ``order``. Map-side combine absorbs a hot key.

    A single numeric order column is the cheapest: its aggregation hashes instead of sorting.
    """
    latest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    scoring = [c for c in (SCORING,) if c in scored.columns]
    return scored.groupBy(*scoring, *SEASON, "player_key", "week").agg(F.max_by("fpts", latest).alias("fpts"))


def season_values(
    scored: DataFrame, env: DataFrame, league: LeagueConfig | Scenarios, order: Sequence[str] = (), weeks: bool = False
) -> DataFrame:
    """One row per (scenario, year, player, team, pos): WAR, flex WARs, games, points and average.

    Weeks without a row count as replacement-level weeks: they add nothing in the own position and a
    constant per season and position in the shared pools, so the missing weeks are never spelt out.
    ``order`` gives the input order when a season may hold several rows of a week, the last of which
    counts; without it such a season raises an error. With ``weeks`` the (at most 18) valued weeks come along as an array.
    Facts with a column ``scoring`` meet the leagues of that scoring only.
    """
    scenarios = Scenarios.of(league)
    scoring = [c for c in (SCORING,) if c in scored.columns]
    facts = last_rows(scored, order) if order else scored
    facts = facts.select(*scoring, "player_key", *SEASON, "week", "fpts")
    # One row per league, season and position. They are written first, so that they can be counted before a broadcast.
    sticks = yardsticks(env, [*scenarios.keys, "year"])
    if scoring:
        sticks = sticks.withColumn(SCORING, scenarios.column(lambda c: scenarios.scorings.index(c.scoring)))
    sticks = materialise(sticks)
    valued = value_scores(facts, sticks, [*scoring, "year"], sticks.count())
    if not scenarios.single:
        valued = within_scenario(valued, scenarios)
    aggregates = [
        "sum(war) AS war",
        "sum(flex_war) AS flex_war",
        "sum(superflex_war) AS superflex_war",
        "int(count(1)) AS games",
        *([] if order else ["bit_count(bit_or(shiftleft(1L, week))) AS _weeks"]),
        "sum(fpts) AS fpts",
        "max(flex_missed) AS flex_missed",
        "max(superflex_missed) AS superflex_missed",
        *(["array_sort(collect_list(struct(week, fpts, war))) AS weeks"] if weeks else []),
    ]
    season = [*scenarios.keys, *SEASON, "player_key"]
    missed = f"({scenarios.sql(lambda c: c.weeks)} - games)"
    return (
        valued.groupBy(*season)
        .agg(*[F.expr(a) for a in aggregates])
        .selectExpr(
            *season,
            "war",
            f"flex_war + {missed} * flex_missed AS flex_war",
            f"superflex_war + {missed} * superflex_missed AS superflex_war",
            "games" if order else f"CASE WHEN games = _weeks THEN games ELSE raise_error('{REPEATED}') END AS games",
            "fpts",
            "coalesce(try_divide(fpts, games), 0D) AS avg",
            *(["weeks"] if weeks else []),
        )
    )


def _season_order(ties: Sequence[str]):
    return [rank_key(F.col("war")).desc(), *[F.col(t).asc() for t in ties]]


def rank_seasons(seasons: DataFrame, keys: Sequence[str] = ("year", "pos"), ties: Sequence[str] = TIES) -> DataFrame:
    """All seasons with ``rank`` by WAR inside (year, position)."""
    return number_rows(seasons, _season_order(ties), "rank", within=keys)


def top_seasons(
    seasons: DataFrame, limit: int, keys: Sequence[str] = ("year", "pos"), ties: Sequence[str] = TIES
) -> DataFrame:
    """Only the seasons ranked ``limit`` or better; cheaper than ranking all."""
    return best_rows(seasons, _season_order(ties), limit, keys, "rank")


def rank_curve(seasons: DataFrame, keys: Sequence[str] = (), ties: Sequence[str] = TIES) -> DataFrame:
    """Mean WAR of each position's rank (at most 250) over the seasons that have it."""
    top = top_seasons(seasons, MAX_CURVE_RANK, [*keys, "year", "pos"], ties)
    return top.groupBy(*keys, "pos", "rank").agg(F.avg("war").alias("war"))


def curve_spine(spark) -> DataFrame:
    """Every rank 1..250 of every position."""
    positions = F.explode(F.array(*[F.lit(p) for p in POSITIONS])).alias("pos")
    return spark.range(1, MAX_CURVE_RANK + 1).select(positions, F.col("id").cast("int").alias("rank"))


def full_curve(curve: DataFrame) -> DataFrame:
    """The curve at every rank and position, NULL where no season reaches it."""
    return curve_spine(curve.sparkSession).join(curve, ["pos", "rank"], "left")


def wide_curve(curve: DataFrame) -> DataFrame:
    """Rank by position."""
    wide = full_curve(curve).groupBy("rank").pivot("pos", list(POSITIONS)).agg(F.first("war"))
    return wide.select("rank", *[F.col(p).alias(f"{p.lower()}_war") for p in POSITIONS])

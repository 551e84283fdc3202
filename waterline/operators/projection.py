"""The current projection pool and its value above replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.config import MAX_CURVE_RANK, POSITIONS, LeagueConfig
from waterline.functions.numeric import per_game, rank_key
from waterline.functions.scoring import fantasy_points
from waterline.functions.text import clean_position, entity_key, position_label, row_id
from waterline.operators.model import environment, value_scores, yardsticks
from waterline.operators.pools import pool_ranks
from waterline.operators.ranking import number_rows_by
from waterline.schema import Fields
from waterline.sources.storage import small


def projection_pool(
    rows: DataFrame, config: LeagueConfig, order: str, key: str | None = None, prefer_rescored: bool = False
) -> DataFrame:
    """Typed projections of named entities in the four positions that have an average or a WAR.

    ``order`` is the input-order column (unique; it completes the row id). An average given by the
    source wins over re-scored stats unless ``prefer_rescored``.
    """
    row = Fields(rows)
    player = row.text("player")
    pos = clean_position(row.text("pos"))
    entity = entity_key(player) if key is None else F.col(key).cast("string")
    given, points = row.number("avg"), row.number("fpts")
    rescored = fantasy_points(row, pos, config.scoring)
    total = F.coalesce(rescored, points)
    weekly = per_game(total, config.weeks)
    average = F.coalesce(per_game(rescored, config.weeks), given, weekly) if prefer_rescored else F.coalesce(given, weekly)

    def bound(field: str):
        value = row.number(field)
        return F.when(points.isNotNull(), per_game(value, config.weeks)).otherwise(value)

    typed = rows.select(
        row_id(entity, pos, F.col(order).cast("string")).alias("id"),
        F.col(order).alias("ord"),
        entity.alias("player_key"),
        player.alias("player"),
        row.text("team", "").alias("team"),
        pos.alias("pos"),
        F.floor(row.number("year", float(config.projection_year))).try_cast("int").alias("year"),
        total.alias("fpts"),
        average.alias("avg"),
        bound("high").alias("avg_high"),
        bound("low").alias("avg_low"),
        row.number("existing_war").alias("existing_war"),
        row.number("adp").alias("own_adp"),
        row.number("adp_rank").alias("own_adp_rank"),
    )
    return typed.filter(
        (F.col("player") != "")
        & F.col("pos").isin(*POSITIONS)
        & (F.col("avg").isNotNull() | F.col("existing_war").isNotNull())
    )


def baselines(pool: DataFrame, config: LeagueConfig) -> DataFrame:
    """One row with the pools' projected statistics and the projected team."""
    scored = pool.filter(F.col("avg").isNotNull()).select("id", "pos", "avg", "ord")
    ranked = pool_ranks(scored, config, periods=(), ties=("ord",), unique=True, score="avg")
    return environment(ranked, config, keys=(), at_least_one=True, score="avg")


def with_history(env: DataFrame, history: DataFrame | None) -> DataFrame:
    """Swap in the historical team when there is one; ``source`` tells which was used."""
    if history is None:
        return env.withColumn("source", F.lit("projection"))
    past = history.agg(F.max(F.struct("team_avg", "team_std")).alias("t")).scalar()
    past_avg, past_std = past["team_avg"], past["team_std"]
    return env.withColumns(
        {
            "source": F.when(past_avg.isNotNull(), "historical").otherwise("projection"),
            "team_avg": F.coalesce(past_avg, F.col("team_avg")),
            "team_std": F.greatest(F.coalesce(past_std, F.col("team_std")), F.lit(1.0)),
        }
    )


def projected_war(pool: DataFrame, env: DataFrame, config: LeagueConfig) -> DataFrame:
    """Add ``war``, ``flex_war`` and ``superflex_war`` for the whole selected season.

    Rows that only bring a finished WAR keep it and get no shared-pool values.
    """
    sticks = yardsticks(env, keys=(), strict_superflex=False)
    valued = value_scores(pool, sticks, on=(), bound=len(POSITIONS), score="avg")
    weeks = F.lit(config.weeks)
    return valued.select(
        *pool.columns,
        F.coalesce(F.col("war") * weeks, F.col("existing_war")).alias("war"),
        (F.col("flex_war") * weeks).alias("flex_war"),
        (F.col("superflex_war") * weeks).alias("superflex_war"),
    )


def rank_projections(valued: DataFrame) -> DataFrame:
    """Add ``pos_rank`` with its label, and ``overall_rank``, by WAR; one layout of the rows serves both."""
    best_first = [rank_key(F.col("war")).desc(), F.col("ord").asc()]
    ranked = number_rows_by(valued, best_first, {"pos_rank": "pos", "overall_rank": None}, len(POSITIONS))
    return ranked.withColumn("pos_rank_label", position_label(F.col("pos_rank"), F.col("pos")))


def attach_curve(
    ranked: DataFrame, curve: DataFrame | None, curve_rows: int = MAX_CURVE_RANK * len(POSITIONS)
) -> DataFrame:
    """Add ``historical_war`` of the same position rank, and the difference to it.

    ``curve_rows`` bounds the curve; the default holds for ``rank_curve``, not for imported ones.
    """
    if curve is None:
        past = ranked.withColumn("historical_war", F.lit(None).cast("double"))
    else:
        rounded = F.floor(F.col("rank").cast("double") + 0.5).try_cast("int")
        # An imported curve may hold fractional ranks that round onto a whole one: the exact rank wins.
        choice = F.struct((F.col("rank") == rounded).cast("int"), -F.col("rank"))
        # A rank that is missing or rounds to less than 1 is nobody's.
        lookup = curve.filter(rounded >= 1).groupBy("pos", rounded.alias("pos_rank")).agg(F.max_by("war", choice).alias("historical_war"))
        past = ranked.join(small(lookup, curve_rows), ["pos", "pos_rank"], "left")
    return past.withColumn("delta_vs_historical", F.col("war") - F.col("historical_war"))

"""Market draft order: normalisation, join to projections and value against it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.functions.text import entity_key, market_name
from waterline.schema import Fields


def normalise_market(market: DataFrame, order: str | None = None, key: str | None = None) -> DataFrame:
    """(player_key, adp, adp_rank), one row per key: the last one in input ``order``.

    Without ``order`` the row with the greatest rank is taken as the last. The aggregation combines
    map-side, so a key with very many rows is no hot spot.
    """
    row = Fields(market)
    text = row.text("market_text", "")
    player = F.coalesce(row.text("market_player"), market_name(text))
    named = market.filter(F.coalesce(F.nullif(player, F.lit("")), F.nullif(text, F.lit(""))).isNotNull())
    typed = named.select(
        (entity_key(player) if key is None else F.col(key).cast("string")).alias("player_key"),
        row.number("market_adp").alias("adp"),
        row.number("market_rank").alias("adp_rank"),
        (F.col(order) if order else row.number("market_rank")).alias("_order"),
    )
    last = F.max_by(F.struct("adp", "adp_rank"), F.struct("_order", "adp", "adp_rank")).alias("last")
    return typed.groupBy("player_key").agg(last).select("player_key", "last.adp", "last.adp_rank")


def attach_market(pool: DataFrame, market: DataFrame) -> DataFrame:
    """Left join on ``player_key``; the projection's own draft columns come first, then the market's.

    ``pool`` brings ``own_adp`` and ``own_adp_rank``. The market side is unique per key but grows
    with the players, so no broadcast is forced: Spark decides by size, and AQE splits a hot key.
    """
    side = market.select("player_key", F.col("adp").alias("_adp"), F.col("adp_rank").alias("_rank"))
    joined = pool.join(side, "player_key", "left")
    adp = F.coalesce("own_adp", "own_adp_rank", "_adp")
    return joined.withColumns({"adp": adp, "adp_rank": F.coalesce(F.col("own_adp_rank"), F.col("_rank"), adp)}).drop(
        "own_adp", "own_adp_rank", "_adp", "_rank"
    )


def value_against_market(ranked: DataFrame) -> DataFrame:
    """Add ``adp_discount`` and ``value`` (the discount scaled by the share of the best WAR)."""
    best = ranked.agg(F.greatest(F.max(F.greatest("war", F.lit(0.0))), F.lit(1.0)).alias("best"))
    discount = F.col("adp") - F.col("overall_rank")
    weight = F.greatest(F.col("war"), F.lit(0.0)) / best.scalar()
    return ranked.withColumn("adp_discount", discount).withColumn("value", F.col("adp_discount") * weight)


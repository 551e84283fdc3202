"""Current projections valued against replacement, history and the market."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.config import LeagueConfig
from waterline.operators.market import attach_market, normalise_market, value_against_market
from waterline.operators.projection import (
    attach_curve,
    baselines,
    projected_war,
    projection_pool,
    rank_projections,
    with_history,
)
from waterline.operators.tiers import assign_tiers


@dataclass(frozen=True)
class Valuation:
    results: DataFrame
    env: DataFrame


def value_projections(
    rows: DataFrame,
    config: LeagueConfig,
    order: str,
    market: DataFrame | None = None,
    key: str | None = None,
    market_key: str | None = None,
    market_order: str | None = None,
    team: DataFrame | None = None,
    curve: DataFrame | None = None,
    tiers: bool = True,
) -> Valuation:
    """The full result table.

    ``team`` is the historical team (``HistoryModel.team``) and ``curve`` the rank curve; without
    them the projected team is used and the historical columns are NULL.
    """
    pool = projection_pool(rows, config, order, key)
    if market is None:
        pool = pool.withColumns(
            {
                "adp": F.coalesce("own_adp", "own_adp_rank"),
                "adp_rank": F.coalesce("own_adp_rank", "own_adp"),
            }
        ).drop("own_adp", "own_adp_rank")
    else:
        pool = attach_market(pool, normalise_market(market, market_order, market_key))
    env = with_history(baselines(pool, config), team)
    ranked = rank_projections(projected_war(pool, env, config))
    if tiers:
        ranked = assign_tiers(ranked)
    return Valuation(value_against_market(attach_curve(ranked, curve)), env)

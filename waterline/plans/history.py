"""Weekly history to season values and rank curve, for one league or a sweep of scenarios."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from waterline.config import SCORING, LeagueConfig, Scenarios
from waterline.operators.model import environment, mean_team, pool_model, team_model
from waterline.operators.pools import pool_ranks
from waterline.operators.season import TIES, eligible, rank_curve, rank_seasons, score_weekly, score_weekly_each, season_values, top_seasons
from waterline.sources.storage import materialise, small


@dataclass(frozen=True)
class HistoryModel:
    """Frames of one league's history. Asking for ``seasons`` writes the small season model first.

    ``make_seasons`` values the seasons of the scored rows it is given.
    """

    scored: DataFrame
    ranked_heads: DataFrame
    env: DataFrame
    make_seasons: Callable[[DataFrame], DataFrame]
    ties: tuple[str, ...] = TIES

    @cached_property
    def seasons(self) -> DataFrame:
        return self.make_seasons(self.scored)

    def seasons_of(self, entities: DataFrame, bound: int) -> DataFrame:
        """``seasons`` of the chosen (player_key, pos) ``entities``, of which there are ``bound`` at most.

        Only their own rows are valued, so the seasons of all others are not made to be dropped; a repeated week of
        another entity does not raise here. Sessions that ask for more than this should store "facts" and "env".
        """
        own = small(entities.select("player_key", "pos"), bound)
        return self.make_seasons(self.scored.join(own, ["player_key", "pos"], "left_semi"))

    @property
    def pools(self) -> DataFrame:
        return pool_model(self.env)

    @property
    def teams(self) -> DataFrame:
        return team_model(self.env)

    @property
    def team(self) -> DataFrame:
        return mean_team(self.env)

    @property
    def curve(self) -> DataFrame:
        return rank_curve(self.seasons, ties=self.ties)

    def ranked(self) -> DataFrame:
        return rank_seasons(self.seasons, ties=self.ties)

    def top(self, limit: int) -> DataFrame:
        return top_seasons(self.seasons, limit, ties=self.ties)


def history_model(
    weekly: DataFrame,
    league: LeagueConfig,
    key: str | None = None,
    order: Sequence[str] = (),
    scored: bool = False,
    weeks: bool = False,
    ties: Sequence[str] = TIES,
    store: Collection[str] = (),
) -> HistoryModel:
    """Model of ``weekly``.

    ``order`` lists the input-order columns of a table that may repeat (season, week) rows; leave it
    out when the table is known to hold each at most once, which saves an exchange. ``scored``: the
    table already holds ``score_weekly`` output. ``store`` may name "facts" (the scored rows) and "env"
    (the small season model) to write them to the shared folder at once, for sessions that derive
    several results from them.
    """
    facts = weekly if scored else score_weekly(weekly, league.scoring, key, carry=order)
    if "facts" in store:
        # Before the filter, which would go down to the source and parse the cells of text sources anew for every condition.
        facts = materialise(facts)
    facts = eligible(facts, league)
    heads = pool_ranks(facts, league, ties=["id", *order], unique=not order)
    env = environment(heads, league)
    if "env" in store:
        env = materialise(env)
    return HistoryModel(facts, heads, env, lambda rows: season_values(rows, env, league, order, weeks), tuple(ties))


def scenario_seasons(
    weekly: DataFrame, scenarios: Scenarios, key: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Season values of every scenario. The facts are read for the heads and for the values, whatever number of scorings there is."""
    facts = eligible(score_weekly_each(weekly, scenarios, key, carry=order), scenarios)
    heads = pool_ranks(facts, scenarios, (SCORING, "year", "week"), ties=["id", *order], unique=not order)
    return season_values(facts, environment(heads, scenarios), scenarios, order)

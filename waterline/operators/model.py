"""Score distributions of pools and of whole teams.

The environment has one row per season (or one in all, for a projection): a struct of statistics per
pool plus the team composite. Every other view of the model is a projection of that row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.config import FLEX_POSITIONS, POOLS, POSITIONS, LeagueConfig, Scenarios
from waterline.functions.numeric import (
    erf_scale_sql,
    erf_sql,
    mean_or_zero_sql,
    spread_sql,
    standing_sql,
    win_share_sql,
    wins_above_sql,
)
from waterline.operators.pools import in_pool_sql
from waterline.sources.storage import small


def environment(
    ranked: DataFrame,
    league: LeagueConfig | Scenarios,
    keys: Sequence[str] = ("year",),
    at_least_one: bool = False,
    score: str = "fpts",
) -> DataFrame:
    """Pool structs (avg, std, replacement, n_actual, n_nominal), ``team_avg`` and ``team_std`` by ``keys``."""
    scenarios = Scenarios.of(league)
    grouping = [*scenarios.keys, *keys]
    marked = ranked.selectExpr(
        *grouping,
        *[
            f"CASE WHEN {in_pool_sql(pool, role, scenarios, at_least_one)} THEN {score} END AS {pool}_{role}"
            for pool in POOLS
            for role in ("starter", "replacement")
        ],
    )
    stats, pools, total, variance = [], [], [], []
    for pool in POOLS:
        top, rest = f"{pool}_starter", f"{pool}_replacement"
        stats += [
            F.expr(f"{mean_or_zero_sql(top)} AS {pool}_avg"),
            F.expr(f"{spread_sql(top)} AS {pool}_std"),
            F.expr(f"{mean_or_zero_sql(rest)} AS {pool}_rep"),
            F.expr(f"int(count({top})) AS {pool}_n"),
        ]
        nominal = scenarios.sql(lambda cfg, pool=pool: cfg.starters(pool))
        slots = scenarios.sql(lambda cfg, pool=pool: cfg.roster[pool])
        std = f"{pool}_std"
        if at_least_one and pool == "SUPERFLEX":
            # A projection's SUPERFLEX of no slots is all zeros, spread included.
            std = f"CASE WHEN {nominal} = 0 THEN 0D ELSE {std} END"
        pools.append(
            f"struct({pool}_avg AS avg, {std} AS std, {pool}_rep AS replacement, {pool}_n AS n_actual, "
            f"int({nominal}) AS n_nominal) AS {pool}"
        )
        total.append(f"{pool}_avg * {slots}")
        variance.append(f"{pool}_std * {pool}_std * {slots}")
    return (
        marked.groupBy(*grouping)
        .agg(*stats)
        .selectExpr(
            *grouping,
            *pools,
            f"{' + '.join(total)} AS team_avg",
            f"greatest(sqrt({' + '.join(variance)}), 1D) AS team_std",
        )
    )


def pool_model(env: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Long form (keys, pool, avg, std, replacement, n_actual, n_nominal)."""
    entries = ", ".join(f"struct('{pool}' AS pool, {pool} AS s)" for pool in POOLS)
    return env.selectExpr(*keys, f"explode(array({entries})) AS e").select(*keys, "e.pool", "e.s.*")


def team_model(env: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    return env.select(*keys, "team_avg", "team_std")


def mean_team(env: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the yearly team averages and spreads; NULL values when there is no season."""
    return env.groupBy(*keys).agg(F.avg("team_avg").alias("team_avg"), F.avg("team_std").alias("team_std"))


def yardsticks(env: DataFrame, keys: Sequence[str] = ("year",), strict_superflex: bool = True) -> DataFrame:
    """Per (keys, position) all that is needed to value a score of that position.

    The replacement halves of the win shares and the value of a missed week are constants of the
    season and position, so they are worked out here once instead of per fact row.
    ``strict_superflex``: SUPERFLEX needs actual starters (seasons) rather than nominal slots.
    """
    members = ", ".join(f"struct('{pos}' AS pos, {pos} AS own)" for pos in POSITIONS)
    flexible = f"pos IN ({', '.join(repr(p) for p in FLEX_POSITIONS)})"
    superflexible = f"SUPERFLEX.{'n_actual' if strict_superflex else 'n_nominal'} > 0"

    def shared(pool: str, open_to: str, prefix: str) -> list[str]:
        base = win_share_sql(f"{pool}.replacement", f"{pool}.avg", "team_std")
        missed = wins_above_sql("own.replacement", f"{pool}.avg", f"{pool}.replacement", "team_std")
        return [
            f"CASE WHEN {open_to} THEN {value} END AS {prefix}_{name}"
            for name, value in (("avg", f"{pool}.avg"), ("base", base), ("missed", missed))
        ]

    return env.selectExpr(*keys, "team_std", "FLEX", "SUPERFLEX", f"inline(array({members}))").selectExpr(
        *keys,
        "pos",
        "own.avg AS own_avg",
        f"{win_share_sql('own.replacement', 'own.avg', 'team_std')} AS own_base",
        *shared("FLEX", flexible, "flex"),
        *shared("SUPERFLEX", superflexible, "superflex"),
        "team_std",
    )


def value_scores(scored: DataFrame, sticks: DataFrame, on: Sequence[str], bound: int, score: str = "fpts") -> DataFrame:
    """Add ``war``, ``flex_war`` and ``superflex_war`` of each row's score for one period.

    This runs once per fact row. The steps of the error function are columns of their own, so the
    generated code computes each once and stays small enough for the JVM to compile.
    """
    joined = scored.join(small(sticks, bound), [*on, "pos"])
    prefixes = {"own": "war", "flex": "flex_war", "superflex": "superflex_war"}
    standing = [f"{standing_sql(score, f'{p}_avg', 'team_std')} AS _{p}_z" for p in prefixes]
    scale = [f"{erf_scale_sql(f'_{p}_z')} AS _{p}_t" for p in prefixes]
    values = [
        f"0.5D * (1D + {erf_sql(f'_{p}_z', f'_{p}_t')}) - {p}_base AS {name}" for p, name in prefixes.items()
    ]
    return joined.selectExpr("*", *standing).selectExpr("*", *scale).selectExpr(*joined.columns, *values)

"""Starters and replacements of every pool.

Position pools rank a position's rows; FLEX ranks the RB/WR/TE rows whose entity starts nowhere yet;
SUPERFLEX ranks everything still left after FLEX. Only a short head of each position can reach any
pool, so the facts are cut to that head first, and the three dependent rankings run on the head.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.config import FLEX_POSITIONS, POOLS, POSITIONS, LeagueConfig, Scenarios
from waterline.operators.ranking import best_rows
from waterline.sources.storage import materialise, small

# Rank column of each shared pool; the position pools share ``pos_rank``.
POOL_COLUMNS = {"position": "pos_rank", "FLEX": "flex_rank", "SUPERFLEX": "superflex_rank"}
# The engine limits a group before the shuffle only up to this many rows (Spark's default threshold).
_GROUP_LIMIT = 1000


def _reach(cfg: LeagueConfig) -> int:
    """How many entities of one position, best first, may matter to some pool.

    A position pool looks at 2c rows. FLEX looks at 2f rows after at most c entities left, and
    SUPERFLEX at 2s rows after at most c + f left. Pools of no slots still look at one row.
    """
    c = max(cfg.starters(p) for p in POSITIONS)
    f, s = cfg.starters("FLEX"), cfg.starters("SUPERFLEX")
    return max(2 * c, c + 2 * max(f, 1), c + f + 2 * s, 1)


def _row_reach(cfg: LeagueConfig) -> int:
    """How many rows of one entity in one period may matter to some pool."""
    return max(2 * max(cfg.starters(p) for p in (*POSITIONS, "FLEX", "SUPERFLEX")), 1)


def _heads(scored: DataFrame, periods: Sequence[str], order: list[Column], scenarios: Scenarios, unique: bool):
    """Every row of each (period, position) that can reach a pool, and few others."""
    entities = scenarios.highest(_reach)
    group = [*periods, "pos"]
    if unique:
        return best_rows(scored, order, entities, group, "_head").drop("_head")

    # An entity may have many rows in a period. Twice the reach covers a few duplicates; a group
    # whose head holds too few different entities is done again from all of its rows.
    limit = min(2 * entities, max(entities, _GROUP_LIMIT))
    head = best_rows(scored, order, limit, group, "_head")
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    first = F.row_number().over(Window.partitionBy(*group, "id").orderBy("_head")) == 1
    head = (
        head.withColumn("_new", first.cast("int"))
        .withColumn("_entities", F.sum("_new").over(whole))
        .withColumn("_rows", F.count(F.lit(1)).over(whole))
        .withColumn("_whole", (F.col("_entities") >= entities) | (F.col("_rows") < limit))
    )
    # Heads are short; written once, they tell how many groups are crowded, usually none.
    head = materialise(head.select(*scored.columns, "_whole"))
    covered = head.filter("_whole").select(*scored.columns)
    crowded = head.filter(~F.col("_whole")).select(*group).distinct()
    n_crowded = crowded.count()
    if not n_crowded:
        return covered
    return covered.unionByName(_crowded_heads(scored, small(crowded, n_crowded), group, order, scenarios))


def _crowded_heads(scored: DataFrame, crowded: DataFrame, group: list[str], order: list[Column], scenarios: Scenarios):
    """Heads of groups crowded by one entity's rows: limit rows per entity, then entities."""
    rows = scored.join(crowded, group, "left_semi")
    # An entity is placed by its best row.
    mine = best_rows(rows, order, scenarios.highest(_row_reach), [*group, "id"], "_own")
    best = mine.filter(F.col("_own") == 1)
    keep = best_rows(best, order, scenarios.highest(_reach), group, "_at").select(*group, "id")
    return mine.join(keep, [*group, "id"], "left_semi").select(*scored.columns)


def within_scenario(df: DataFrame, scenarios: Scenarios) -> DataFrame:
    """Rows inside their own scenario's weeks and look-back."""
    return df.filter(
        (F.col("week") <= scenarios.column(lambda c: c.weeks))
        & (F.col("year") >= scenarios.column(lambda c: c.start_year))
    )


def pool_ranks(
    scored: DataFrame,
    league: LeagueConfig | Scenarios,
    periods: Sequence[str] = ("year", "week"),
    ties: Sequence[str] = ("id",),
    unique: bool = False,
    score: str = "fpts",
) -> DataFrame:
    """Head rows with ``pos_rank``, ``flex_rank`` and ``superflex_rank`` (NULL outside a pool).

    ``scored`` has (periods, id, pos, score, ties); ``id`` is the entity inside its position. With
    ``unique`` the caller states that an entity has at most one row per period.
    """
    scenarios = Scenarios.of(league)
    order = [F.col(score).desc(), *[F.col(t).asc() for t in ties]]
    heads = scenarios.expand(_heads(scored, periods, order, scenarios, unique))
    if not scenarios.single:
        heads = within_scenario(heads, scenarios)
    keys = [*scenarios.keys, *periods]
    within = ", ".join(keys) or "0"
    best_first = ", ".join([f"{score} DESC", *ties])
    flex_members = ", ".join(repr(p) for p in FLEX_POSITIONS)

    def limit(pool: str) -> str:
        return scenarios.sql(lambda cfg: cfg.starters(pool))

    def rank(pool: str) -> str:
        return f"row_number() OVER (PARTITION BY {within}, {pool} ORDER BY {best_first})"

    def any_row(flag: str) -> str:
        return f"max({flag}) OVER (PARTITION BY {within}, pos, id)"

    slots = "CASE pos " + " ".join(f"WHEN '{p}' THEN {limit(p)}" for p in POSITIONS) + " END"
    # All windows are partitioned within a period, so one exchange of the heads on the period serves them.
    return (
        (heads.repartition(*keys) if keys else heads.repartition(1))
        .selectExpr("*", f"{rank('pos')} AS pos_rank")
        .selectExpr("*", f"NOT {any_row(f'pos_rank <= {slots}')} AS _free")
        .selectExpr("*", f"_free AND pos IN ({flex_members}) AS _flex")
        .selectExpr("*", f"CASE WHEN _flex THEN {rank('_flex')} END AS flex_rank")
        .selectExpr("*", f"_free AND NOT {any_row('coalesce(flex_rank <= ' + limit('FLEX') + ', false)')} AS _super")
        .selectExpr("*", f"CASE WHEN _super THEN {rank('_super')} END AS superflex_rank")
        .drop("_free", "_flex", "_super")
    )


def in_pool_sql(pool: str, role: str, scenarios: Scenarios, at_least_one: bool) -> str:
    """Whether a ranked head row is a ``role`` ("starter" or "replacement") of ``pool``.

    ``at_least_one``: a pool of no slots still has its first row as starter and as replacement,
    which is how projection pools behave; SUPERFLEX of no slots is always empty.
    """
    floor = 1 if at_least_one and pool != "SUPERFLEX" else 0
    rank = POOL_COLUMNS.get(pool, "pos_rank")
    count = scenarios.sql(lambda cfg: cfg.starters(pool))
    if role == "starter":
        hit = f"{rank} <= greatest({count}, {floor})"
    else:
        hit = f"{rank} > {count} AND {rank} <= greatest({count} * 2, {floor})"
    return f"(pos = '{pool}' AND {hit})" if pool in POSITIONS else f"({hit})"


def roles(ranked: DataFrame, league: LeagueConfig | Scenarios, at_least_one: bool = False) -> DataFrame:
    """Long form: one row per head row, pool and role it has."""
    scenarios = Scenarios.of(league)
    tags = ", ".join(
        f"CASE WHEN {in_pool_sql(pool, role, scenarios, at_least_one)} THEN struct('{pool}' AS pool, '{role}' AS role) END"
        for pool in POOLS
        for role in ("starter", "replacement")
    )
    kept = [c for c in ranked.columns if c not in POOL_COLUMNS.values()]
    return ranked.selectExpr(*kept, f"inline(array_compact(array({tags})))")

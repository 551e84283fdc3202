import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from waterline.config import POOLS, LeagueConfig, Roster
from waterline.operators.market import normalise_market
from waterline.operators.model import pool_model
from waterline.operators.projection import attach_curve, baselines, projection_pool
from waterline.plans import series
from waterline.plans.valuation import value_projections
from waterline.sources.sinks import EXPORT_COLUMNS, export_frame

SCHEMA = "ord int, Player string, Team string, POS string, AVG double, WAR double"


def pool_rows(seed, n=80):
    rng = random.Random(seed)
    return [(i, f"p{chr(97 + i // 26)}{chr(97 + i % 26)}", "T", ("QB1", "rb", "WR", "TE2", "DST")[i % 5], float(rng.randint(0, 250)) / 10, None)
            for i in range(n)]


def expected(rows, cfg, team=None):
    """Baselines, the team and WAR by row order."""
    clean = [(r[0], r[3].upper().rstrip("12"), r[4]) for r in rows]
    clean = [r for r in clean if r[1] in brute.POSITIONS]
    slots = {p: cfg.roster[p] for p in POOLS}
    starters = {p: slots[p] * cfg.teams for p in slots}
    stats = brute.statistics([brute.pools_of([(o, p, a, o) for o, p, a in clean if a is not None], starters, 1)])
    if not starters["SUPERFLEX"]:
        stats["SUPERFLEX"] = (0.0, 0.0, 0.0, 0)
    whole = team or brute.team(stats, slots)
    std = max(whole[1], 1.0)

    def value(pool, score):
        return cfg.weeks * (brute.share(score, stats[pool][0], std) - brute.share(stats[pool][2], stats[pool][0], std))

    wars = {}
    for o, p, a in clean:
        if a is not None:
            wars[o] = (
                value(p, a),
                value("FLEX", a) if p != "QB" else None,
                value("SUPERFLEX", a) if starters["SUPERFLEX"] else None,
            )
    return stats, whole, wars


LEAGUES = [
    LeagueConfig(teams=2, weeks=17),
    LeagueConfig(teams=2, weeks=10, roster=Roster(SUPERFLEX=1)),
    LeagueConfig(teams=2, weeks=10, roster=Roster(QB=0, TE=0, FLEX=0)),
    LeagueConfig(teams=1, weeks=10, roster=Roster(0, 0, 0, 0, 0, 0)),
]


@pytest.mark.parametrize("cfg", LEAGUES, ids=range(len(LEAGUES)))
def test_baselines_and_war(spark, cfg):
    rows = pool_rows(1)
    stats, whole, wars = expected(rows, cfg)
    df = spark.createDataFrame(rows, SCHEMA)
    found = value_projections(df, cfg, "ord", tiers=False)
    got = {r.pool: r for r in pool_model(found.env, keys=("team_avg", "team_std")).collect()}
    for pool, (avg, std, replacement, _) in stats.items():
        r = got[pool]
        assert (r.avg, r.std, r.replacement, r.n_nominal) == pytest.approx((avg, std, replacement, cfg.starters(pool))), pool
        assert (r.team_avg, r.team_std) == pytest.approx(whole)
    results = found.results.collect()
    assert len(results) == len(wars)
    for r in results:
        assert (r.war, r.flex_war, r.superflex_war) == pytest.approx(wars[r.ord], abs=1e-6)
    ordered = sorted(results, key=lambda r: (-round(r.war, 9), r.ord))
    assert [r.overall_rank for r in ordered] == list(range(1, len(ordered) + 1))
    for pos in brute.POSITIONS:
        mine = [r for r in ordered if r.pos == pos]
        assert [r.pos_rank_label for r in mine] == [f"{i}{pos}" for i in range(1, len(mine) + 1)]


def test_finished_war_and_missing_rows(spark):
    rows = pool_rows(2, 40) + [(100, "only war", "T", "WR", None, 1.25), (101, "nothing", "T", "WR", None, None), (102, "", "T", "WR", 5.0, None)]
    found = value_projections(spark.createDataFrame(rows, SCHEMA), LEAGUES[0], "ord", tiers=False).results
    got = {r.ord: r for r in found.collect()}
    assert (got[100].war, got[100].flex_war, got[100].superflex_war) == (1.25, None, None)
    assert 101 not in got and 102 not in got
    assert got[100].id == "onlywar-WR-100"


def test_averages_from_points_and_bounds(spark):
    cfg = LeagueConfig(weeks=10)
    df = spark.createDataFrame(
        [(1, "a", "QB", "170", "", "200", "100", ""), (2, "b", "QB", "", "", "20", "", "7"), (3, "c", "QB", "100", "50", "", "", "")],
        "ord int, Name string, position string, FPTS string, REC string, High string, Low string, `FPTS/G` string",
    )
    got = {r.ord: r for r in projection_pool(df, cfg, "ord").collect()}
    assert (got[1].fpts, got[1].avg, got[1].avg_high, got[1].avg_low) == (170.0, 17.0, 20.0, 10.0)
    assert (got[2].avg, got[2].avg_high) == (7.0, 20.0)
    assert (got[3].fpts, got[3].avg) == (50.0, 5.0)
    flipped = df.withColumn("FPTS/G", F.lit("9"))
    assert {r.avg for r in projection_pool(flipped, cfg, "ord").collect()} == {9.0}
    assert [r.avg for r in projection_pool(flipped.filter("ord = 3"), cfg, "ord", prefer_rescored=True).collect()] == [5.0]


def test_historical_team_and_its_absence(spark):
    rows = pool_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    past = spark.createDataFrame([(120.0, 21.0)], "team_avg double, team_std double")
    found = value_projections(df, LEAGUES[0], "ord", team=past, tiers=False)
    assert found.env.first().source == "historical"
    _, _, wars = expected(rows, LEAGUES[0], (120.0, 21.0))
    for r in found.results.collect():
        assert r.war == pytest.approx(wars[r.ord][0], abs=1e-6)
    empty = past.agg(F.avg("team_avg").alias("team_avg"), F.avg("team_std").alias("team_std")).filter("team_avg < 0")
    none = value_projections(df, LEAGUES[0], "ord", team=empty, tiers=False)
    assert none.env.first().source == "projection"


def test_market_rows(spark):
    df = spark.createDataFrame(
        [(1, "Josh Allen", "", "3.5", "1"), (2, "", "Bijan Robinson ATL (5)", "1,001.5", "2"), (3, "josh allen!", "", "9", "7"),
         (4, "", "", "1", "1"), (5, "", "Odd Text", "-", "4")],
        "row int, Name string, `Player Team (Bye)` string, AVG string, Rank string",
    )
    got = {r.player_key: (r.adp, r.adp_rank) for r in normalise_market(df, "row").collect()}
    assert got == {"joshallen": (9.0, 7.0), "bijanrobinson": (1001.5, 2.0), "oddtext": (None, 4.0)}


def test_market_join_and_value(spark):
    cfg = LEAGUES[0]
    rows = pool_rows(4, 60)
    market = spark.createDataFrame([(f"P{r[1][1:]}", float(i), i) for i, r in enumerate(rows[:30], 1)], "Player string, ADP double, Rank int")
    got = value_projections(spark.createDataFrame(rows, SCHEMA), cfg, "ord", market=market, tiers=False).results.collect()
    best = max(max(r.war, 0) for r in got)
    for r in got:
        if r.ord < 30:
            assert (r.adp, r.adp_rank) == (r.ord + 1, r.ord + 1)
            assert r.value == pytest.approx((r.adp - r.overall_rank) * max(r.war, 0) / max(best, 1))
        else:
            assert r.adp is None and r.value is None
    own = spark.createDataFrame(rows, SCHEMA).withColumn("ADP Rank", F.lit("12"))
    first = value_projections(own, cfg, "ord", market=market, tiers=False).results.first()
    assert (first.adp, first.adp_rank) == (12.0, 12.0)


def test_curve_lookup_prefers_the_exact_rank(spark):
    ranked = spark.createDataFrame([("QB", 43, 1.0), ("QB", 42, 1.0), ("RB", 1, 1.0)], "pos string, pos_rank int, war double")
    curve = spark.createDataFrame([("QB", 42.5, 9.0), ("QB", 43.0, 0.25), ("QB", 41.6, 0.5)], "pos string, rank double, war double")
    got = {(r.pos, r.pos_rank): (r.historical_war, r.delta_vs_historical) for r in attach_curve(ranked, curve, 10).collect()}
    assert got == {("QB", 43): (0.25, 0.75), ("QB", 42): (0.5, 0.5), ("RB", 1): (None, None)}


def test_tables_for_reports(spark):
    cfg = LEAGUES[0]
    rows = pool_rows(5, 60)
    market = spark.createDataFrame([(r[1], float(i), i) for i, r in enumerate(rows[:20], 1)], "Player string, ADP double, Rank int")
    found = value_projections(spark.createDataFrame(rows, SCHEMA), cfg, "ord", market=market)
    results = found.results
    got = results.collect()
    assert export_frame(results).columns == [header for header, _ in EXPORT_COLUMNS]

    down = [r.adp for r in series.result_table(results, sort="adp", descending=True).collect()]
    with_adp = sorted((r.adp for r in got if r.adp is not None), reverse=True)
    assert down == [None] * (len(got) - len(with_adp)) + with_adp
    up = [r.adp for r in series.result_table(results, sort="adp").collect()]
    assert up == sorted(with_adp) + [None] * (len(got) - len(with_adp))
    names = [r.player for r in series.result_table(results, ("QB", "TE"), " PA ", "player", rows=5).collect()]
    assert names == sorted(r.player for r in got if r.pos in ("QB", "TE") and "pa" in r.player)[:5]

    card = series.summary(results, found.env).first()
    top = min(got, key=lambda r: r.overall_rank)
    best = max((r for r in got if r.value is not None), key=lambda r: r.value)
    assert (card.player_count, card.top_war_player, card.top_value_player) == (len(got), top.player, best.player)
    assert card.team_source == "projection" and card.qb_replacement == pytest.approx(found.env.first().QB.replacement)

    points = series.metric_against_market(results, "historical_war").collect()
    assert sorted(p.x for p in points) == pytest.approx(sorted(r.war for r in got))
    assert sorted(p.y for p in points) == sorted(float(r.adp if r.adp is not None else r.overall_rank) for r in got)


def test_baselines_of_an_empty_pool(spark):
    empty = projection_pool(spark.createDataFrame([], SCHEMA), LEAGUES[0], "ord")
    row = baselines(empty, LEAGUES[0]).first()
    assert (row.QB.avg, row.QB.std, row.QB.replacement, row.QB.n_nominal) == (0.0, 1.0, 0.0, 2)


def test_curve_rows_without_a_rank_match_nobody(spark):
    from waterline.operators.projection import attach_curve

    ranked = spark.createDataFrame([("QB", 1, 5.0), ("QB", 2, 4.0)], "pos string, pos_rank int, war double")
    curve = [("QB", None, 9.0), ("QB", 0.2, 8.0), ("QB", -3.0, 7.0), ("QB", 1.6, 3.0), ("QB", 2.4, 2.0), ("QB", 1e12, 1.0)]
    got = attach_curve(ranked, spark.createDataFrame(curve, "pos string, rank double, war double")).orderBy("pos_rank").collect()
    assert [r.historical_war for r in got] == [None, 3.0]

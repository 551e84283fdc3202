import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from waterline.config import POOLS, LeagueConfig, Roster, Scenarios
from waterline.operators import pools as pool_ops
from waterline.operators.pools import pool_ranks, roles
from waterline.operators.season import full_curve, rank_curve, wide_curve
from waterline.plans.history import history_model, scenario_seasons

SCHEMA = "player string, team string, pos string, year int, week int, fpts double, ord int"


def scored(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("id", F.concat_ws("-", "player", "pos")).withColumn("player_key", F.col("player"))


def random_rows(seed, players=40, weeks=5, repeats=0, years=(2020, 2021)):
    rng = random.Random(seed)
    rows = []
    for year in years:
        for p in range(players):
            pos = ("QB", "RB", "WR", "TE")[p % 4]
            for week in range(1, weeks + 1):
                if rng.random() < 0.8:
                    for _ in range(1 + (rng.random() < repeats) * rng.randint(1, 6)):
                        club = "A" if rng.random() < 0.9 else "B"
                        rows.append((f"p{p:02d}", club, pos, year, week, float(rng.randint(0, 30)), len(rows)))
    return rows


def check(spark, rows, cfg, order=("ord",)):
    slots = {p: cfg.roster[p] for p in POOLS}
    years, seasons = brute.history(rows, cfg.teams, slots, cfg.weeks)
    found = history_model(scored(spark, rows), cfg, scored=True, order=order)
    got = {(r.year, r.pool): r for r in found.pools.collect()}
    assert len(got) == len(years) * 6
    for year, (stats, _) in years.items():
        for pool, expected in stats.items():
            r = got[year, pool]
            assert (r.avg, r.std, r.replacement, r.n_actual) == pytest.approx(expected), (year, pool)
            assert r.n_nominal == cfg.starters(pool)
    for r in found.teams.collect():
        assert (r.team_avg, r.team_std) == pytest.approx(years[r.year][1])
    values = {(r.year, r.player, r.team, r.pos): r for r in found.seasons.collect()}
    assert set(values) == set(seasons)
    for key, expected in seasons.items():
        r = values[key]
        assert (r.war, r.flex_war, r.superflex_war, r.games, r.fpts) == pytest.approx(expected, abs=5e-8), key
        assert r.avg == pytest.approx(expected[4] / expected[3])
    return found


LEAGUES = {
    "plain": LeagueConfig(teams=2, weeks=5),
    "superflex": LeagueConfig(teams=2, weeks=5, roster=Roster(SUPERFLEX=1)),
    "no flex": LeagueConfig(teams=2, weeks=5, roster=Roster(FLEX=0)),
    "no quarterback": LeagueConfig(teams=2, weeks=5, roster=Roster(QB=0, SUPERFLEX=1)),
    "nothing": LeagueConfig(teams=1, weeks=5, roster=Roster(0, 0, 0, 0, 0, 0)),
    "short": LeagueConfig(teams=3, weeks=3, roster=Roster(SUPERFLEX=2)),
}


@pytest.mark.parametrize("name", LEAGUES)
def test_seasons_without_repeats(spark, name):
    rows = [r for r in random_rows(1) if r[1] == "A"]
    check(spark, rows, LEAGUES[name], order=())


@pytest.mark.parametrize("name", ["plain", "superflex", "short"])
def test_seasons_with_repeated_weeks(spark, name):
    check(spark, random_rows(2, repeats=0.4), LEAGUES[name])


def test_one_entity_crowds_its_position(spark):
    """A player with hundreds of rows in a week fills the head; the group is then done from all rows."""
    rows = random_rows(3, players=60, weeks=2, years=(2020,))
    rows += [("p01", "A", "RB", 2020, 1, 50.0 + i / 1000, 10_000 + i) for i in range(400)]
    cfg = LeagueConfig(teams=2, weeks=2, roster=Roster(SUPERFLEX=1))
    assert 400 > 2 * pool_ops._reach(cfg)
    check(spark, rows, cfg)


def test_result_does_not_depend_on_partitioning(spark):
    rows = [r for r in random_rows(4) if r[1] == "A"]
    df = scored(spark, rows)
    cfg = LEAGUES["superflex"]
    once = sorted(history_model(df.repartition(1), cfg, scored=True).seasons.collect())
    again = sorted(history_model(df.repartition(7, "fpts"), cfg, scored=True).seasons.collect())
    assert [tuple(r)[:5] for r in once] == [tuple(r)[:5] for r in again]
    assert [r.war for r in once] == pytest.approx([r.war for r in again])


def test_starters_and_replacements_are_disjoint(spark):
    rows = [r for r in random_rows(5) if r[1] == "A"]
    cfg = LEAGUES["superflex"]
    tagged = roles(pool_ranks(scored(spark, rows), cfg, unique=True), cfg).collect()
    seen = {}
    for r in tagged:
        assert seen.setdefault((r.year, r.week, r.id, r.pool), r.role) == r.role
    for pool in POOLS:
        per_week = {}
        for r in tagged:
            if r.pool == pool and r.role == "starter":
                per_week[r.year, r.week] = per_week.get((r.year, r.week), 0) + 1
        assert all(n <= cfg.starters(pool) for n in per_week.values())
    starts = [(r.year, r.week, r.id) for r in tagged if r.role == "starter"]
    assert len(starts) == len(set(starts))


def test_salted_limit_gives_the_same_heads(spark):
    from waterline.operators.ranking import best_rows

    df = scored(spark, random_rows(6, repeats=0.5))
    order = [F.col("fpts").desc(), F.col("ord").asc()]
    plain = best_rows(df, order, 3, ["year", "pos"], "at", fan_in=1)
    salted = best_rows(df, order, 3, ["year", "pos"], "at", fan_in=5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.select(*plain.columns).collect()))


def test_weeks_array(spark):
    rows = [("a", "X", "QB", 2020, 3, 5.0, 0), ("a", "X", "QB", 2020, 1, 7.0, 1), ("b", "X", "QB", 2020, 1, 6.0, 2)]
    found = history_model(scored(spark, rows), LeagueConfig(teams=1, weeks=5), scored=True, weeks=True)
    weeks = {r.player: [(w.week, w.fpts) for w in r.weeks] for r in found.seasons.collect()}
    assert weeks == {"a": [(1, 7.0), (3, 5.0)], "b": [(1, 6.0)]}


def test_ranks_and_curve(spark):
    rows = [r for r in random_rows(7) if r[1] == "A"]
    found = history_model(scored(spark, rows), LEAGUES["plain"], scored=True)
    ranked = found.ranked().collect()
    buckets = {}
    for r in ranked:
        buckets.setdefault((r.year, r.pos), []).append(r)
    curve = {}
    for bucket in buckets.values():
        ordered = sorted(bucket, key=lambda r: (-round(r.war, 9), r.player, r.team))
        assert [r.rank for r in ordered] == list(range(1, len(bucket) + 1))
        for r in ordered:
            curve.setdefault((r.pos, r.rank), []).append(r.war)
    got = {(r.pos, r.rank): r.war for r in full_curve(rank_curve(found.seasons)).collect()}
    assert len(got) == 1000
    for key, war in got.items():
        assert war == (pytest.approx(brute.mean(curve[key])) if key in curve else None)
    wide = wide_curve(rank_curve(found.seasons)).orderBy("rank").collect()
    assert len(wide) == 250 and wide[0].qb_war == pytest.approx(got["QB", 1])


def test_scenarios_equal_single_runs(spark):
    weekly = spark.createDataFrame(
        [(p, t, pos, y, w, s) for p, t, pos, y, w, s, _ in random_rows(8) if t == "A"],
        "Player string, Team string, Pos string, Year int, Week int, REC double",
    )
    configs = {
        "a": LeagueConfig(teams=2, weeks=5),
        "b": LeagueConfig(teams=3, weeks=4, start_year=2021, roster=Roster(SUPERFLEX=1)),
        "c": LeagueConfig(teams=2, weeks=5, scoring=LeagueConfig().scoring.__class__(rec=0.5)),
    }
    swept = scenario_seasons(weekly, Scenarios(configs), key="Player").collect()
    for name, cfg in configs.items():
        alone = {(r.year, r.player): r for r in history_model(weekly, cfg, key="Player").seasons.collect()}
        mine = {(r.year, r.player): r for r in swept if r.scenario == name}
        assert set(alone) == set(mine) and alone
        for key, r in alone.items():
            for field in ("war", "flex_war", "superflex_war", "games", "fpts", "avg"):
                assert mine[key][field] == pytest.approx(r[field]), (name, key, field)


def test_stored_model_is_the_same(spark):
    rows = [r for r in random_rows(9) if r[1] == "A"]
    df = scored(spark, rows)
    lazy = history_model(df, LEAGUES["plain"], scored=True)
    stored = history_model(df, LEAGUES["plain"], scored=True, store=("facts", "env"))
    assert lazy.team.first() == pytest.approx(stored.team.first())
    assert sorted(r.war for r in lazy.seasons.collect()) == pytest.approx(sorted(r.war for r in stored.seasons.collect()))


def test_keys_are_whole_and_years_unbounded(spark):
    rows = [("2020", "1"), ("12020", "1"), ("2020", "1.5"), ("99999999999", "1"), ("2020.0", "2.0"), ("x", "3")]
    df = spark.createDataFrame([("P", "QB", y, w, 9.0) for y, w in rows], "Player string, Pos string, Year string, Week string, REC double")
    got = {(r.year, r.games) for r in history_model(df, LeagueConfig(teams=1)).seasons.collect()}
    assert got == {(2020, 2), (12020, 1)}


def test_many_leagues_keep_the_facts_in_place(spark):
    from waterline.config import Scenarios
    from waterline.plans.history import scenario_seasons

    df = spark.createDataFrame([("P", "QB", 2020, 1, 9.0)], "Player string, Pos string, Year int, Week int, REC double")
    sweep = Scenarios({f"l{k}": LeagueConfig(teams=1 + k) for k in range(40)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = scenario_seasons(df, sweep)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_scans_do_not_grow_with_the_scorings(spark, tmp_path, monkeypatch):
    from waterline.plans import history

    weekly = spark.createDataFrame(
        [(p, t, pos, y, w, s) for p, t, pos, y, w, s, _ in random_rows(8) if t == "A"],
        "Player string, Team string, Pos string, Year int, Week int, REC double",
    )
    weekly.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    heads, real = [], history.pool_ranks
    monkeypatch.setattr(history, "pool_ranks", lambda *a, **k: heads.append(real(*a, **k)) or heads[-1])
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/facts")
    for n in (1, 7):
        weights = [LeagueConfig().scoring.__class__(rec=k / 4) for k in range(n)]
        sweep = {f"{k}-{t}": LeagueConfig(teams=t, weeks=5, scoring=w) for k, w in enumerate(weights) for t in (2, 3)}
        seasons = scenario_seasons(facts, Scenarios(sweep), key="Player")
        assert scans(seasons) == 1 and scans(heads[-1]) == 1
        assert {r.scenario for r in seasons.select("scenario").distinct().collect()} == set(sweep)


def test_a_sweep_lays_its_facts_out_by_season(spark, monkeypatch):
    """The sums of a sweep come from the layout of its facts, in as many tasks as the session shuffles into, without an exchange of their own."""
    from waterline.plans import history

    weekly = spark.createDataFrame(
        [(p, t, pos, y, w, s) for p, t, pos, y, w, s, _ in random_rows(9) if t == "A"],
        "Player string, Team string, Pos string, Year int, Week int, REC double",
    )
    heads, real = [], history.pool_ranks
    monkeypatch.setattr(history, "pool_ranks", lambda *a, **k: heads.append(real(*a, **k)) or heads[-1])
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    seasons = scenario_seasons(weekly, Scenarios({"a": LeagueConfig(teams=2, weeks=5), "b": LeagueConfig(teams=3, weeks=4)}), key="Player")
    assert "REPARTITION_BY_NUM" in text(seasons) and "REPARTITION_BY_NUM" in text(heads[0])
    assert text(seasons).count("Exchange hashpartitioning") == 1
    # Rows that do not count are left out before the exchange.
    assert "Filter" not in text(seasons)[: text(seasons).index("REPARTITION_BY_NUM")].split("Generate")[-1]


def test_seasons_of_chosen_entities(spark):
    rows, cfg = random_rows(10), LeagueConfig(teams=2, weeks=5)
    found = history_model(scored(spark, rows), cfg, scored=True, weeks=True)
    chosen = found.top(1).select("player_key", "pos").distinct()
    kept = lambda df: sorted((r.player, r.team, r.pos, r.year, round(r.war, 9), r.games, len(r.weeks)) for r in df.collect())
    want = kept(found.seasons.join(chosen, ["player_key", "pos"], "left_semi"))
    assert want and kept(found.seasons_of(chosen, 8)) == want
    assert found.seasons_of(chosen.limit(0), 0).count() == 0
    # Only the rows of the chosen are valued: the join with them lies below the sums.
    plan = found.seasons_of(chosen, 8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_a_salt_does_not_ask_for_arrays(spark):
    from waterline.operators.ranking import best_rows

    df = spark.range(40).select((F.col("id") % 8).alias("k"), (F.col("id") % 2).alias("g"), "id")
    made = df.groupBy("k", "g").agg(F.max("id").alias("v"), F.collect_list("id").alias("weeks"))
    best = best_rows(made, [F.col("v").desc()], 2, ["g"], "at", fan_in=3)
    assert "collect_list" not in best.select("k", "at")._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.g, r["at"], r.v, len(r.weeks)) for r in best.collect()) == [(0, 1, 38, 5), (0, 2, 36, 5), (1, 1, 39, 5), (1, 2, 37, 5)]


def test_a_single_order_column_needs_no_sort_of_the_facts(spark, tmp_path):
    from waterline.sources.tables import read_csv

    (tmp_path / "a.csv").write_text("Player,Pos,Year,Week,REC,TD,TD\nP,QB,2020,1,5,1,9\nP,QB,2020,1,7,2,9\nQ,QB,2020,1,7,2,9\n")
    (tmp_path / "b.csv").write_text("Player,Pos,Year,Week,REC,TD,TD\nP,QB,2020,1,1,0,9\n\nP,QB,2020,2,3,0,9\n")
    read = read_csv(spark, str(tmp_path), multi_line=False, order="ord")
    assert "TD_1" in read.columns
    found = history_model(read, LeagueConfig(teams=1, weeks=2), key="Player", order=["ord"])
    plan = found.seasons._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert {(r.player, r.games, r.fpts) for r in found.seasons.collect()} == {("P", 2, 4.0), ("Q", 1, 19.0)}


def test_a_repeated_week_needs_an_order(spark):
    rows = [("P", "QB", 2020, 1, 5.0, 1), ("P", "QB", 2020, 1, 9.0, 2)]
    df = spark.createDataFrame(rows, "Player string, Pos string, Year int, Week int, REC double, ord int")
    league = LeagueConfig(teams=1)
    assert [(r.games, r.fpts) for r in history_model(df, league, order=["ord"]).seasons.collect()] == [(1, 9.0)]
    with pytest.raises(Exception, match="holds a week twice"):
        history_model(df, league).seasons.collect()


def test_stored_facts_are_written_before_the_filter(spark, monkeypatch):
    from waterline.plans import history

    rows = [(str(p), "T", "QB", "2020", str(w), str(p + w)) for p in range(4) for w in range(1, 4)] + [("9", "T", "K", "2020", "1", "1")]
    weekly = spark.createDataFrame(rows, "Player string, Team string, Pos string, Year string, Week string, REC string")
    written, real = [], history.materialise
    monkeypatch.setattr(history, "materialise", lambda df: written.append(df) or real(df))
    want = history.history_model(weekly, LeagueConfig(teams=2, weeks=5), key="Player").scored
    found = history.history_model(weekly, LeagueConfig(teams=2, weeks=5), key="Player", store=("facts",)).scored
    # A filter on the way to the files would parse the cells once more for every condition.
    assert "Filter" not in written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(found.collect()) == sorted(want.collect()) and found.count() == 12


def test_whole_numbers_of_text(spark):
    from waterline.schema import Fields

    cells = ["7", "007", "123456789", "1234567890", "99999999999", "7.0", "7.5", "1e3", " 8 ", "9\n", "-", "", None, "1,000", "+3", "-3", "٣"]
    df = spark.createDataFrame([(c,) for c in cells], "Week string")
    want = [7, 7, 123456789, 1234567890, None, 7, None, 1000, 8, 9, None, None, None, 1000, 3, -3, None]
    assert [r[0] for r in df.select(Fields(df).whole("week")).collect()] == want

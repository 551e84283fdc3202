import math

import pytest
from pyspark.sql import functions as F

from waterline.config import LeagueConfig, Roster, Scenarios, ScoringWeights
from waterline.functions import numeric, scoring, text
from waterline.schema import Fields


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluate(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_numbers(spark):
    df = column(spark, ["1,234.5", "", "-", "  ", "NaN", "Infinity", "1.0d", "0x1A", " 12 ", "-3.5e1", "1e999", ".5", None])
    assert evaluate(df, numeric.to_number(F.col("v"))) == [
        1234.5, None, None, None, None, None, None, None, 12.0, -35.0, None, 0.5, None,
    ]


def test_erf_matches_the_error_function(spark):
    xs = [-4 + i * 0.05 for i in range(161)] + [0.0]
    found = evaluate(column(spark, xs, "double"), numeric.erf("v"))
    assert max(abs(a - math.erf(x)) for a, x in zip(found, xs)) < 1.5e-7
    assert found[-1] == 0.0


def test_normal_cdf_steps_without_spread(spark):
    df = column(spark, [-1.0, 0.0, 1.0], "double")
    assert evaluate(df, numeric.normal_cdf("v", "0D", "0D")) == [0.0, 1.0, 1.0]
    assert evaluate(df, numeric.normal_cdf("v", "0D", "double('Infinity')")) == [0.0, 1.0, 1.0]
    assert evaluate(df, numeric.normal_cdf("v", "0D", "double(null)")) == [0.0, 1.0, 1.0]
    assert evaluate(df, numeric.normal_cdf("v", "0D", "1D"))[1] == 0.5


def test_wins_above_grows_with_score_and_is_zero_at_replacement(spark):
    df = column(spark, [float(v) for v in range(0, 40)], "double")
    found = evaluate(df, numeric.wins_above("v", "20D", "12D", "25D"))
    assert found == sorted(found) and found[12] == 0.0


def test_mean_and_spread(spark):
    for values, m, s in (([], 0.0, 1.0), ([10.0], 10.0, 2.0), ([2.0, 4.0], 3.0, 1.0), ([3.0, None, float("nan")], 3.0, 1.0)):
        row = column(spark, values, "double").agg(numeric.mean_or_zero("v"), numeric.spread("v")).first()
        assert tuple(row) == pytest.approx((m, s))


def test_ranks_and_centers(spark):
    df = column(spark, [None, 0.2, 1.5, 2.49, 42.5], "double")
    assert evaluate(df, numeric.whole_rank("v")) == [1, 1, 2, 2, 43]
    centers = F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))
    assert evaluate(column(spark, [0.0, 2.0, 2.1], "double"), numeric.nearest(F.col("v"), centers)) == [0, 0, 1]


def test_keys_and_positions(spark):
    df = column(spark, ["Ja'Marr Chase Jr.", None, "RB12"])
    assert evaluate(df, text.entity_key(F.col("v"))) == ["jamarrchasejr", "", "rb"]
    assert evaluate(df, text.clean_position(F.col("v")))[2] == "RB"


@pytest.mark.parametrize(
    "cell, strict, bare",
    [
        ("Josh AllenBUFhighlow", ("Josh Allen", "BUF"), ("Josh Allen", "BUF")),
        ("Kenneth Walker IIIKC(5)", ("Kenneth Walker III", "KC"), ("Kenneth Walker II", "IKC")),
        ("Travis KelceKC(10)", ("Travis Kelce", "KC"), ("Travis Kelce", "KC")),
        ("Josh Allen (BUF)", ("Josh Allen", "BUF"), ("Josh Allen", "BUF")),
        ("Josh Allen  BUF (7)", ("Josh Allen", "BUF"), ("Josh Allen", "BUF")),
        (" Josh Allen (Rookie) ", ("Josh Allen", ""), ("Josh Allen", "")),
        ("Some OneXYZ(3)", ("Some One", "XYZ"), ("Some One", "XYZ")),
    ],
)
def test_player_and_team(spark, cell, strict, bare):
    df = column(spark, [cell])
    assert tuple(evaluate(df, text.split_player_team(F.col("v")))[0]) == strict
    assert tuple(evaluate(df, text.split_player_team(F.col("v"), None))[0]) == bare


def test_run_together_numbers(spark):
    df = column(spark, ["412.5430.1395.2", "12", "", None, "1,412.5-3.1", "7 8 9 10"])
    assert evaluate(df, text.split_high_low(F.col("v"))) == [
        [412.5, 430.1, 395.2], [12.0], [], None, [1412.5, -3.1], [7.0, 8.0, 9.0],
    ]


def test_tokens(spark):
    rows = text.entity_tokens(spark, "Josh Allen, ,Travis Kelce:2020, X:y").orderBy("token").collect()
    assert [(r.name, r.key, r.start) for r in rows] == [
        ("Josh Allen", "joshallen", None), ("Travis Kelce", "traviskelce", 2020.0), ("X", "x", None),
    ]


def test_alias_order_and_fall_through(spark):
    df = spark.createDataFrame([("", "3", "a"), ("-", "3", ""), ("2", "", "")], "REC string, Receptions string, `p l a y e r` string")
    row = Fields(df)
    found = df.select(row.number("rec", 0.0).alias("rec"), row.text("player", "none").alias("player")).collect()
    assert [tuple(r) for r in found] == [(3.0, "a"), (0.0, "none"), (2.0, "none")]
    assert row.resolve(["receptions"]) == ["Receptions"]


def test_points(spark):
    weights = ScoringWeights(te_premium=0.5)
    df = spark.createDataFrame(
        [("TE", "4", "50", "1"), ("WR", "4", "50", "1"), ("WR", "", "", "")], "Pos string, REC string, `Rec YDS` string, FL string"
    )
    found = [r[0] for r in df.select(scoring.fantasy_points(Fields(df), F.col("Pos"), weights)).collect()]
    assert found == pytest.approx([4 * 1.5 + 5 - 2, 4 + 5 - 2, None])


def test_bare_yards_feed_two_stats_but_prove_none(spark):
    df = spark.createDataFrame([("QB", "100", None), ("QB", "100", "1")], "Pos string, YDS string, INT string")
    found = [r[0] for r in df.select(scoring.fantasy_points(Fields(df), F.col("Pos"), ScoringWeights())).collect()]
    assert found == [None, pytest.approx(100 * 0.1 + 100 * 0.04 - 2)]


def test_config():
    assert LeagueConfig.clamped(40).weeks == 18 and LeagueConfig.clamped(0).weeks == 1
    for bad in (dict(teams=0), dict(weeks=19), dict(weeks=0), dict(teams=1.5)):
        with pytest.raises(ValueError):
            LeagueConfig(**bad)
    with pytest.raises(ValueError):
        Roster(FLEX=-1)
    assert ScoringWeights(rec=0.5).label() == "Half PPR" and ScoringWeights(rec=0).label() == "Standard"
    assert ScoringWeights(rec=0.7, te_premium=0.5).label() == "0.7 PPR / TE+0.5"
    assert LeagueConfig(roster=Roster(SUPERFLEX=1)).label().startswith("12 teams / 1QB / 2RB / 2WR / 1TE / 1 Flex / 1 SuperFlex")
    sweep = Scenarios({"a": LeagueConfig(), "b": LeagueConfig(teams=8)})
    assert sweep.sql(lambda c: c.weeks) == "17" and "element_at" in sweep.sql(lambda c: c.teams)

import pytest
from pyspark.sql import functions as F

from waterline.functions.text import entity_tokens
from waterline.plans import series

SCHEMA = (
    "year int, player string, team string, pos string, player_key string, war double, flex_war double, "
    "superflex_war double, games int, fpts double, avg double, weeks array<struct<week:int,fpts:double,war:double>>"
)


@pytest.fixture(scope="module")
def seasons(spark):
    rows = []
    for year in range(2018, 2022):
        for i, (player, pos) in enumerate([("Al B", "QB"), ("Cy D", "RB"), ("Al B", "WR")]):
            war = float(year - 2018 + 10 * i)
            weeks = [(1, 5.0, war / 2), (3, 7.0, war / 2)]
            rows.append((year, player, "T", pos, player.replace(" ", "").lower(), war, war / 2, None, 2, 12.0, 6.0, weeks))
    rows.append((2021, "Cy D", "S", "RB", "cyd", 99.0, 1.0, None, 1, 3.0, 3.0, [(2, 3.0, 99.0)]))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_token_trend(spark, seasons):
    tokens = entity_tokens(spark, "Al B:2020, cy d:0, nobody")
    chosen = series.token_seasons(seasons, tokens)
    got = sorted(tuple(r) for r in series.entity_trend(chosen, ["series"], "war").select("series", "pos", "team", "x").collect())
    assert [g for g in got if g[0] == 0] == [(0, p, "T", y) for p in ("QB", "WR") for y in (2020, 2021)]
    assert len([g for g in got if g[0] == 1]) == 5
    aligned = series.entity_trend(chosen, ["series"], "war", True, 3).filter("series = 1").orderBy("x").collect()
    assert [(r.x, r.year, r.team) for r in aligned] == [(1, 2018, "T"), (2, 2019, "T"), (3, 2020, "T"), (4, 2021, "S"), (5, 2021, "T")]


def test_default_trend(seasons):
    got = series.default_seasons(seasons, 2)
    assert {(r.player, r.pos) for r in got.collect()} == {("Cy D", "RB"), ("Al B", "WR")} and got.count() == 9


def test_rank_trend(seasons):
    top = seasons.withColumn("rank", F.when(F.col("team") == "S", 1).otherwise(2))
    got = series.rank_trend(top, 2, ["war"], 2019, 2020, ("RB",)).collect()
    assert [(r.pos, r.year, r.metric, r.value) for r in got] == [("RB", 2019, "war", 11.0), ("RB", 2020, "war", 12.0)]


def test_history_and_week_grid(spark, seasons):
    chosen = spark.createDataFrame([("cyd", "RB")], "player_key string, pos string")
    history = series.entity_history(seasons, chosen, 1)
    assert [(r.year, r.team) for r in history.collect()] == [(2021, "S"), (2021, "T"), (2020, "T"), (2019, "T"), (2018, "T")]
    grid = {r.metric: r for r in series.week_grid(series.newest_season(history), 4).collect()}
    assert (grid["fpts"].w1, grid["fpts"].w2, grid["war"].w2, grid["war"].w4) == (None, 3.0, 99.0, None)


def test_sort_text_blank_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "team string")
    assert [r.team for r in df.orderBy(*series.sort_columns(df, "team")).collect()] == [None, "a", "b"]
    assert [r.team for r in df.orderBy(*series.sort_columns(df, "team", True)).collect()] == ["b", "a", None]


def test_text_goes_by_locale(spark):
    names = ["Zoe", "zoe", "Émile", "emile", "Emile", "émile", "abe", None, "Abe", "zoë", "Ab e"]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "team string, k int")
    ordered = [None, "Ab e", "abe", "Abe", "emile", "Emile", "émile", "Émile", "zoe", "Zoe", "zoë"]
    assert [r.team for r in df.orderBy(*series.sort_columns(df, "team")).collect()] == ordered
    assert [r.team for r in series.place_rows(df.repartition(3), "team", ["k"]).orderBy("place").collect()] == ordered
    points = [r.team for r in df.orderBy(*series.sort_columns(df, "team", collation=None)).collect()]
    assert points == [None, *sorted(n for n in names if n)]


def scanned_rows(df):
    """Rows that the file reader gave, after it skipped what it could."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_an_entity_is_found_without_reading_all_seasons(spark, tmp_path, monkeypatch):
    rows = [(2000 + y, f"P{k}", "T", "QB", f"p{k:05d}", float(k), None, None, 1, 1.0, 1.0, None) for k in range(4000) for y in range(3)]
    path = str(tmp_path / "seasons")
    series.store_by_entity(spark.createDataFrame(rows, SCHEMA), path, row_group=200)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        some = [("p00017", "QB"), ("p03999", "QB"), ("p00100", "WR")]
        found = series.stored_history(spark, path, some)
        assert [(r.player, r.year) for r in found.collect()] == [(p, y) for p in ("P17", "P3999") for y in (2002, 2001, 2000)]
        assert 0 < scanned_rows(series.stored_history(spark, path, some)) <= 3 * 2 * 200
        # A key between others, which no row has, is ruled out by the Bloom filters.
        assert scanned_rows(series.stored_history(spark, path, [("p00017x", "QB")])) == 0
        assert series.stored_history(spark, path, []).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_default_trend_reads_the_facts_once(spark, seasons, tmp_path, monkeypatch):
    seasons.write.parquet(str(tmp_path / "facts"))
    facts, stored = spark.read.parquet(str(tmp_path / "facts")), []
    real = series.materialise
    monkeypatch.setattr(series, "materialise", lambda df: stored.append(df) or real(df))
    found = series.default_seasons(facts.filter("war > -1"), 2)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/facts")
    assert scans(found) == 0 and [scans(df) for df in stored] == [1]
    assert {(r.player, r.pos) for r in found.collect()} == {("Cy D", "RB"), ("Al B", "WR")}
    assert series.default_seasons(facts.limit(0), 2).count() == 0

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.config import POSITIONS, LeagueConfig, Roster, Scenarios, ScoringWeights
from waterline.functions.text import entity_tokens, split_high_low, split_player_team
from waterline.operators import tiers as tiering
from waterline.operators.market import attach_market, normalise_market
from waterline.operators.model import pool_model, team_model
from waterline.operators.pools import pool_ranks, roles
from waterline.operators.projection import baselines, projection_pool
from waterline.operators.season import full_curve, top_seasons, wide_curve
from waterline.plans import series
from waterline.plans.history import HistoryModel, history_model, scenario_seasons
from waterline.plans.valuation import Valuation, value_projections
from waterline.registry import fixtures as fx
from waterline.sources import ingest, pages, sinks, tables
from waterline.sources.backfill import WeeklyStore, append_rows, expected_periods, missing_periods
from waterline.sources.backfill import backfill_from_pages as fill_from_pages
from waterline.sources.storage import materialise, scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
OUTPUT_DIGITS, SHIFT = 6, 1e-10
# Parameters shared with the reference SQL.
TREND_RANK = 3
TREND_TOKENS = "7, 11:1998, 23:0"
CARD_RANK = 1
BALANCED_TIERS = 30
FIXED_CENTERS = {2: (0.5, 2.5), 3: (0.0, 1.0, 3.0), 5: (-1.0, 0.0, 1.0, 2.0, 4.0)}
SWEEP = {
    "base": LeagueConfig(weeks=12, start_year=1995, scoring=fx.WEIGHTS),
    "small": LeagueConfig(teams=8, weeks=10, start_year=1997, scoring=fx.WEIGHTS, roster=Roster(SUPERFLEX=1)),
    "premium": LeagueConfig(
        weeks=12,
        start_year=1995,
        scoring=ScoringWeights(
            rec=1.0, te_premium=0.5, rec_yds=0.0001, rec_td=0, rush_yds=0, rush_td=0, pass_yds=0, pass_td=0, ints=-2.0, fl=-2.0
        ),
        roster=Roster(WR=3),
    ),
}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns, doubles at six places.

    The tiny shift keeps exact halves, such as the mean of four six-place scores, from rounding by
    the noise of their sum; adding zero turns a negative zero into a plain one.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    double = lambda c: f"round(`{c}` + {SHIFT}D, {OUTPUT_DIGITS}) + 0D AS `{c}`"
    return df.selectExpr(*[double(c) if isinstance(kinds[c], T.DoubleType) else f"`{c}`" for c in columns or df.columns])


def model(
    spark: SparkSession, sf_dir: str, league: LeagueConfig = fx.WEEKLY_LEAGUE, weeks: bool = False, store: tuple = ()
) -> HistoryModel:
    return history_model(fx.weekly(spark, sf_dir), league, key="Player", weeks=weeks, store=store)


def valuation(spark: SparkSession, sf_dir: str, history: bool = False, tiers: bool = False, **extra) -> Valuation:
    past = model(spark, sf_dir, store=("env",)) if history else None
    return value_projections(
        fx.projections(spark, sf_dir),
        fx.POOL_LEAGUE,
        order="custkey",
        market=fx.market(spark, sf_dir),
        key="custkey",
        market_key="custkey",
        team=past.team if past else None,
        curve=past.curve if past else None,
        tiers=tiers,
        **extra,
    )


# --- weekly history ---------------------------------------------------------------------------------


@query
def score_weekly(spark, sf):
    return rounded(model(spark, sf).scored, "year", "week", "id", "team", "pos", "fpts")


@query
def position_roles(spark, sf):
    tagged = roles(model(spark, sf).ranked_heads, fx.WEEKLY_LEAGUE)
    return rounded(tagged.filter(F.col("pool").isin(*POSITIONS)), "year", "week", "id", "pool", "role", "fpts")


@query
def flex_roles(spark, sf):
    tagged = roles(model(spark, sf, fx.SUPERFLEX_LEAGUE).ranked_heads, fx.SUPERFLEX_LEAGUE)
    return rounded(tagged.filter(~F.col("pool").isin(*POSITIONS)), "year", "week", "id", "pool", "role", "fpts")


@query
def flex_roles_events(spark, sf):
    scored = fx.event_scores(spark, sf).filter(F.col("pos").isin(*POSITIONS))
    tagged = roles(pool_ranks(scored, fx.EVENT_LEAGUE, unique=True), fx.EVENT_LEAGUE)
    return rounded(tagged, "year", "week", "id", "pool", "role", "fpts")


@query
def pool_stats_by_year(spark, sf):
    stats = pool_model(model(spark, sf, fx.SUPERFLEX_LEAGUE).env)
    return rounded(stats, "year", "pool", "avg", "std", "replacement", "n_actual", "n_nominal")


@query
def team_by_year(spark, sf):
    return rounded(team_model(model(spark, sf).env))


@query
def team_mean(spark, sf):
    return rounded(model(spark, sf).team)


SEASON_COLUMNS = ("year", "player", "team", "pos", "war", "flex_war", "superflex_war", "games", "fpts", "avg")


@query
def season_value(spark, sf):
    return rounded(model(spark, sf).seasons, *SEASON_COLUMNS)


@query
def season_value_superflex(spark, sf):
    return rounded(model(spark, sf, fx.SUPERFLEX_LEAGUE).seasons, *SEASON_COLUMNS)


@query
def season_value_duplicates(spark, sf):
    repeated = fx.weekly_duplicates(spark, sf)
    found = history_model(repeated, fx.WEEKLY_LEAGUE, key="Player", order=fx.DUPLICATE_ORDER)
    return rounded(found.seasons, *SEASON_COLUMNS)


@query
def csv_season_value(spark, sf):
    """From written CSV with repeated headers and repeated weeks to season values, the place in the input deciding ties and last rows."""
    path = scratch_path(spark, "facts")
    fx.write_weekly_csv(spark, sf, path)
    read = tables.read_csv(spark, path, multi_line=False, order="ord")
    return rounded(history_model(read, fx.WEEKLY_LEAGUE, key="Player", order=["ord"], store=("facts",)).seasons, *SEASON_COLUMNS)


@query
def season_weeks_array(spark, sf):
    flat = model(spark, sf, weeks=True).seasons.select("year", "player", "team", "pos", F.explode("weeks").alias("w"))
    return rounded(flat.select("year", "player", "team", "pos", "w.week", "w.fpts", "w.war"))


@query
def season_rank(spark, sf):
    return rounded(model(spark, sf).ranked(), "year", "pos", "rank", "player", "team", "war")


@query
def rank_curve_long(spark, sf):
    return rounded(full_curve(model(spark, sf).curve), "pos", "rank", "war")


@query
def rank_curve_wide(spark, sf):
    return rounded(wide_curve(model(spark, sf).curve))


@query
def scenario_sweep(spark, sf):
    scenarios = Scenarios(SWEEP)
    found = scenario_seasons(fx.weekly(spark, sf), scenarios, key="Player")
    label = scenarios.column(lambda c: c.label()).alias("label")
    return rounded(found.withColumn("label", label), "scenario", "label", *SEASON_COLUMNS)


# --- projections ------------------------------------------------------------------------------------


@query
def projected_pool(spark, sf):
    pool = projection_pool(fx.projections(spark, sf), fx.POOL_LEAGUE, "custkey", key="custkey")
    return rounded(pool, "id", "player", "team", "pos", "year", "avg")


@query
def projected_baselines(spark, sf):
    pool = projection_pool(fx.projections(spark, sf), fx.POOL_LEAGUE, "custkey", key="custkey")
    env = baselines(pool, fx.POOL_LEAGUE)
    stats = pool_model(env.withColumn("source", F.lit("projection")), keys=("team_avg", "team_std"))
    return rounded(stats, "pool", "avg", "std", "replacement", "n_nominal", "team_avg", "team_std")


@query
def projected_value(spark, sf):
    found = valuation(spark, sf).results
    return rounded(found, "id", "pos", "avg", "war", "flex_war", "superflex_war", "pos_rank_label", "overall_rank")


@query
def market_order(spark, sf):
    return rounded(normalise_market(fx.market(spark, sf), key="custkey"), "player_key", "adp", "adp_rank")


@query
def value_vs_market(spark, sf):
    found = valuation(spark, sf).results
    return rounded(found, "id", "overall_rank", "adp", "adp_rank", "adp_discount", "value")


@query
def delta_vs_history(spark, sf):
    found = valuation(spark, sf, history=True).results
    return rounded(found, "id", "pos", "pos_rank", "war", "historical_war", "delta_vs_historical")


@query
def tiers_rank_balanced(spark, sf):
    pool = projection_pool(fx.projections(spark, sf), fx.POOL_LEAGUE, "custkey", key="custkey")
    order = [F.col("avg").desc(), F.col("ord").asc()]
    return tiering.rank_balanced(pool, BALANCED_TIERS, order).select("id", "overall_rank", "tier")


@query
def tiers_silhouette_fixed(spark, sf):
    pool = projection_pool(fx.projections(spark, sf), fx.POOL_LEAGUE, "custkey", key="custkey")
    line = tiering.value_line(pool.select("avg"), "avg")
    scaled = {k: np.array(c) * 10 for k, c in FIXED_CENTERS.items()}
    rows = [(k, float(s)) for k, s in tiering.silhouettes(line, scaled).items()]
    return rounded(spark.createDataFrame(rows, "k int, score double"))


@query
def tiers_kmeans(spark, sf):
    found = valuation(spark, sf, tiers=True).results
    return rounded(found, "id", "pos", "overall_rank", "war", "tier")


# --- reports ----------------------------------------------------------------------------------------


@query
def visible_top(spark, sf):
    shown = series.result_table(valuation(spark, sf).results, ("QB", "TE"), "nation_1", "value", descending=True)
    return rounded(shown, "id", "player", "team", "pos", "overall_rank", "value")


@query
def names_by_locale(spark, sf):
    """All names of mixed case and accents with their place in text order, either way."""
    up = series.place_rows(fx.mixed_names(spark, sf), "name", ["p_partkey"])
    return series.place_rows(up, "name", ["p_partkey"], descending=True, out="place_down").select("p_partkey", "name", "place", "place_down")


@query
def ranked_projection_table(spark, sf):
    shown = series.result_table(valuation(spark, sf, history=True, tiers=True).results)
    columns = ("overall_rank", "player", "team", "pos", "pos_rank_label", "war", "flex_war", "superflex_war")
    return rounded(shown, *columns, "historical_war", "delta_vs_historical", "adp", "value", "tier")


@query
def summary_cards(spark, sf):
    found = valuation(spark, sf)
    return rounded(series.summary(found.results, found.env))


@query
def metric_vs_market(spark, sf):
    return rounded(series.metric_against_market(valuation(spark, sf).results, "value"))


@query
def metric_vs_market_fallback(spark, sf):
    return rounded(series.metric_against_market(valuation(spark, sf).results, "historical_war"))


@query
def curve_series(spark, sf):
    return rounded(series.curve_series(model(spark, sf).curve, ("RB", "WR")))


@query
def rank_trend(spark, sf):
    found = model(spark, sf, fx.SUPERFLEX_LEAGUE)
    return rounded(series.rank_trend(found.top(TREND_RANK), TREND_RANK, series.SEASON_METRICS, 1996, 2000))


def _token_trend(spark, sf, aligned):
    tokens = entity_tokens(spark, TREND_TOKENS, letters_only=False)
    chosen = series.token_seasons(series.between_years(model(spark, sf).seasons, 1996, 2001), tokens)
    return rounded(series.entity_trend(chosen, ["series"], "war", aligned, len(TREND_TOKENS.split(","))), "series", "player", "pos", "year", "x", "y")


@query
def entity_trend_calendar(spark, sf):
    return _token_trend(spark, sf, aligned=False)


@query
def entity_trend_aligned(spark, sf):
    return _token_trend(spark, sf, aligned=True)


@query
def entity_trend_default(spark, sf):
    chosen = series.default_seasons(series.between_years(model(spark, sf).seasons, 1996, 2000))
    trend = series.entity_trend(chosen, ["player_key", "pos"], "fpts", True, series.DEFAULT_TREND_ENTITIES)
    return rounded(trend, "player_key", "player", "pos", "year", "x", "y")


@query
def entity_season_card(spark, sf):
    """The best entities' cards, looked up in seasons stored by entity."""
    found, path = model(spark, sf), scratch_path(spark, "seasons")
    series.store_by_entity(found.seasons, path)
    # The best of every season and position, looked up as a user's choice would be.
    chosen = top_seasons(spark.read.parquet(path), CARD_RANK).select("player_key", "pos").distinct().collect()
    return rounded(series.stored_history(spark, path, [tuple(r) for r in chosen]), *SEASON_COLUMNS)


@query
def entity_week_grid(spark, sf):
    found = model(spark, sf, weeks=True, store=("facts", "env"))
    chosen = materialise(found.top(CARD_RANK).select("player_key", "pos").distinct())
    n_chosen = chosen.count()
    history = series.entity_history(found.seasons_of(chosen, n_chosen), chosen, n_chosen)
    return rounded(series.week_grid(series.newest_season(history), fx.WEEKLY_LEAGUE.weeks))


# --- sources and sinks ------------------------------------------------------------------------------


@query
def missing_periods_grid(spark, sf):
    loaded = fx.weekly(spark, sf).select(F.col("Year").alias("year"), F.col("Week").alias("week"), F.col("Pos").alias("pos"))
    return missing_periods(expected_periods(spark, 1995, 2001, last_week=17), loaded)


@query
def union_by_position(spark, sf):
    stats = fx.weekly(spark, sf)
    catchers = stats.filter("Pos = 'WR'").select("Player", "Pos", "Year", "Week", "REC", "ReceivingYDS")
    passers = stats.filter("Pos = 'QB'").select("Player", "Pos", "Year", "Week", "INTS")
    runners = stats.filter("Pos = 'RB'").select("Player", "Pos", "Year", "Week", "REC")
    stacked = append_rows(ingest.union_positions([passers, catchers, runners]), stats.filter("Pos = 'TE'").drop("Team"))
    kept = stacked.filter(~F.col("Player").isin("7", "11")).withColumn("scoring", F.lit("ppr"))
    return rounded(kept, "Player", "Pos", "Year", "Week", "INTS", "REC", "ReceivingYDS", "FL", "scoring")


@query
def split_entity_text(spark, sf):
    parts = split_player_team(F.col("text"))
    bare = split_player_team(F.col("text"), teams=None)
    return fx.source_text(spark, sf).select(
        "p_partkey",
        parts["player"].alias("player"),
        parts["team"].alias("team"),
        bare["player"].alias("bare_player"),
        bare["team"].alias("bare_team"),
    )


@query
def split_number_text(spark, sf):
    numbers = split_high_low(F.col("cell"))
    at = lambda i: F.try_element_at(numbers, F.lit(i))
    cells = fx.source_text(spark, sf)
    return cells.select("p_partkey", at(1).alias("main"), at(2).alias("high"), at(3).alias("low"))


@query
def html_table_cells(spark, sf):
    return pages.table_cells(fx.stat_pages(spark, sf), ["player", "year"], "html")


@query
def html_table_wide(spark, sf):
    headers = ["Week", "QTY", "Column", "QTY_1", "absent"]
    return pages.table_columns(fx.stat_pages(spark, sf), ["player", "year"], "html", headers)


@query
def backfill_from_pages(spark, sf):
    """Two runs over stored pages, one of them mended in between; the weekly rows with their run, and the pages set aside."""
    store = WeeklyStore(scratch_path(spark, "history"))
    expected = expected_periods(spark, 1995, 2001, last_week=12)
    fill_from_pages(fx.weekly_pages(spark, sf, mended=False), store, expected, "first")
    fill_from_pages(fx.weekly_pages(spark, sf, mended=True), store, expected, "second")
    rows = store.weekly(spark).join(F.broadcast(store.loads(spark).drop("rows")), ["year", "week", "pos"])  # a row a period of the grid
    aside = store.quarantine(spark).groupBy("year", "week", "pos", "problem", "run").agg(F.count(F.lit(1)).alias("pages"))
    stats = ("PassingYDS", "RushingYDS", "ReceivingYDS", "REC", "INTS", "FL", "G")
    named = rows.select("year", "week", "pos", "run", F.col("Player").alias("player"), F.col("Team").alias("team"), *[F.col(c).alias(c.lower()) for c in stats])
    return rounded(named.unionByName(aside, allowMissingColumns=True))


@query
def market_from_pages(spark, sf):
    """Stored market pages to a written market table, read back."""
    path = scratch_path(spark, "market")
    cells = pages.stat_frame(fx.market_pages(spark, sf), ["page"], "html").drop("page", "row")
    sinks.write_table_csv(ingest.market_table(cells, 2026), path)
    back = tables.read_csv(spark, path)
    return rounded(back.selectExpr("int(Year) AS year", "Player AS player", "Team AS team", "double(`ADP Rank`) AS adp_rank", "POS AS pos", "double(ADP) AS adp"))


@query
def projections_from_pages(spark, sf):
    """Stored projection pages to every position's projections, with the page and row they come from."""
    stored = materialise(fx.projection_pages(spark, sf))
    frames = {p: pages.stat_frame(stored.filter(F.col("pos") == p), ["page"], "html") for p in POSITIONS}
    found = ingest.current_projections(frames, 2026, ("red widget", "hot ring"), keys=("page", "row"))
    stats = ("PassingYDS", "RushingYDS", "ReceivingYDS High", "PassingTD Low", "RushingTD", "ReceivingTD", "FL", "FL High")
    named = [F.col(c).alias(c.lower().replace(" ", "_")) for c in stats]
    return rounded(found.select("Year", "Player", "Team", "Pos", "page", "row", *named))


@query
def named_pool_market(spark, sf):
    """Projections joined to market pages by the letters of names, one side out of the pages' text; season totals per clamped week."""
    cells = pages.stat_frame(fx.market_pages(spark, sf), ["page"], "html")
    pool = projection_pool(fx.named_projections(spark, sf), fx.CLAMPED_LEAGUE, "custkey")
    joined = attach_market(pool, normalise_market(cells))
    return rounded(joined, "id", "player_key", "player", "pos", "fpts", "avg", "avg_high", "avg_low", "adp", "adp_rank")


@query
def ingest_projections(spark, sf):
    cells = fx.source_text(spark, sf)
    page = lambda pos, *stats: cells.filter(F.col("pos") == pos).select(
        F.col("text").alias("Player"), *[F.col("cell").alias(s) for s in stats]
    )
    found = ingest.current_projections(
        {
            "QB": page("QB", "YDS", "TDS", "YDS_1", "FL"),
            "RB": page("RB", "REC", "TD", "TD_1"),
            "WR": page("WR", "REC", "YDS", "TDS"),
            "TE": page("TE", "YDS", "TD", "FL"),
        },
        2026,
        ("red widget", "hot ring"),
    )
    return found.groupBy("Year", "Player", "Team", "Pos").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        *[
            (F.round(F.sum(F.col(c)), 4) + F.lit(0.0)).alias(c.lower().replace(" ", "_"))
            for c in ("PassingYDS", "RushingYDS High", "PassingTD Low", "FL", "REC", "RushingTD", "ReceivingTD High", "ReceivingYDS")
        ],
    )


@query
def ingest_market(spark, sf):
    cells = fx.source_text(spark, sf).select(
        F.col("p_partkey").alias("Rank"), F.col("text").alias("Player Team (Bye)"), F.col("pos").alias("POS"), F.col("cell").alias("AVG")
    )
    found = ingest.market_table(cells, 2026)
    return rounded(found.withColumnsRenamed({"ADP Rank": "adp_rank"}), "Year", "Player", "Team", "adp_rank", "POS", "ADP")


@query
def ingest_weekly(spark, sf):
    cells = fx.source_text(spark, sf)
    stats = cells.select("pos", F.col("text").alias("Player"), F.col("q").cast("string").alias("REC"), F.col("cell").alias("YDS"),
                         F.col("p_partkey").cast("string").alias("YDS_1"), F.col("p_partkey").alias("row"))
    found = ingest.union_positions(
        [ingest.weekly_table(stats.filter(F.col("pos") == p).drop("pos"), p.lower(), 2024, 3) for p in POSITIONS]
    )
    return rounded(found, "Year", "Week", "Pos", "Player", "Team", "REC", "PassingYDS", "ReceivingYDS", "RushingYDS", "row")


@query
def source_fallbacks(spark, sf):
    path, absent = scratch_path(spark, "projections"), scratch_path(spark, "absent")
    source = fx.projections(spark, sf).withColumn("Name", F.concat(F.lit('"'), "Name", F.lit('", Jr.')))
    sinks.write_table_csv(source, path)
    inputs = tables.read_projection_inputs(spark, absent, absent, fallback=path)
    past = tables.read_weekly_history(spark, absent).select("Player", F.lit("history").alias("source"))
    pool = projection_pool(inputs.projections, fx.POOL_LEAGUE, "custkey", key="custkey")
    rows = pool.select("player", F.lit("fallback").alias("source"), "team", "pos", "avg")
    listed = inputs.market.select(F.col("Player").alias("player"), F.lit("market").alias("source"))
    stacked = rows.unionByName(listed, True).unionByName(past.withColumnRenamed("Player", "player"), True)
    return rounded(stacked)


@query
def manifest_document(spark, sf):
    path = scratch_path(spark, "manifest")
    items = fx.table(spark, sf, "lineitem")
    one = items.agg(
        F.concat(F.date_format(F.max("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias("updated_at"),
        F.min(F.year("l_shipdate")).alias("historical_start_year"),
        F.max(F.year("l_shipdate")).alias("historical_end_year"),
    )
    one.write.json(path)
    read = tables.manifest_time(tables.read_json_document(spark, path))
    kept = read.filter("historical_start_year is not null")
    stamp = F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at")
    return kept.select(stamp, "season_year", "historical_start_year", "historical_end_year")


@query
def manifest_merge(spark, sf):
    """A good, a damaged and an old manifest document merged with a run's own entries, through a compacted log."""
    folder, log, compacted = (scratch_path(spark, n) for n in ("documents", "log", "compacted"))
    facts = fx.table(spark, sf, "lineitem").agg(F.min(F.year("l_shipdate")).alias("first"), F.max(F.year("l_shipdate")).alias("last"), F.count(F.lit(1)).alias("rows"))
    good = facts.select(F.to_json(F.struct(F.lit("2024-03-01T12:00:00+02:00").alias("updated_at"), "first", "last", "rows")).alias("value"))
    old = good.select(F.lit('{"updated_at": "2024-01-01T00:00:00Z", "adp_scoring": "half", "rows": 1, "gone": null}').alias("value"))
    damaged = good.select(F.concat(F.lit('{"updated_at": "2025-01-01T00:00:00Z", "first": 1, '), F.substring("value", 5, 30)).alias("value"))
    for name, document in (("good", good), ("damaged", damaged), ("old", old)):
        document.coalesce(1).write.text(f"{folder}/{name}")
    sinks.append_run_log(tables.manifest_entries(spark, f"{folder}/*/part-*"), log)
    run = facts.select(F.lit("job").alias("key"), F.lit("run").alias("value"), F.lit("2024-03-02 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    sinks.append_run_log(run, log)
    sinks.compact_run_log(spark, log, compacted)
    merged = sinks.latest_run_values(spark.read.parquet(compacted))
    return merged.select("key", "value", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


@query
def export_roundtrip(spark, sf):
    path = scratch_path(spark, "export")
    sinks.export_results(valuation(spark, sf, history=True, tiers=True).results, path)
    back = tables.read_csv(spark, path)
    kinds = {"Year": "int", "Overall Rank": "int", "Tier": "int", "Player": "string", "Team": "string", "Pos": "string", "Pos Rank": "string"}
    return rounded(
        back.select(*[F.col(c).cast(kinds.get(c, "double")).alias(c.lower().replace(" ", "_")) for c, _ in sinks.EXPORT_COLUMNS])
    )


@query
def weekly_roundtrip(spark, sf):
    """Two loads of the weekly table, the second replacing only its own periods, then a resumed read."""
    path = scratch_path(spark, "weekly")
    facts = model(spark, sf).scored.select("year", "week", "pos", "player", "team", "fpts")
    sinks.write_weekly(facts, path)
    again = facts.filter((F.col("year") == 1996) & (F.col("week") > 6)).withColumn("fpts", F.col("fpts") + 1)
    sinks.write_weekly(again, path)
    return rounded(tables.read_weekly_table(spark, path), "year", "week", "pos", "player", "team", "fpts")


@query
def run_log_latest(spark, sf):
    path = scratch_path(spark, "runlog")
    events = fx.table(spark, sf, "events")
    entries = events.select(F.col("event_type").alias("key"), F.col("props").alias("value"), F.col("ts").alias("updated_at"))
    sinks.append_run_log(entries.filter("updated_at < timestamp_ntz'2024-01-15'"), path)
    sinks.append_run_log(entries.filter("updated_at >= timestamp_ntz'2024-01-15'"), path)
    log = sinks.latest_run_values(spark.read.parquet(path), tie_break="value")
    return log.select("key", "value", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))

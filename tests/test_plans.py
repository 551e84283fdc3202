"""The physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from waterline.config import LeagueConfig, Roster
from waterline.plans.history import history_model
from waterline.plans.valuation import value_projections
from waterline.sources import sinks


@pytest.fixture(autouse=True)
def full_plan_text(spark):
    """Untruncated plans, without the repeats of pruning subqueries."""
    settings = {
        "spark.sql.maxMetadataStringLength": "100000",
        "spark.sql.debug.maxToStringFields": "1000",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def weekly(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("weekly") / "t")
    rows = spark.range(4000).select(
        (F.lit(2014) + F.col("id") % 4).cast("int").alias("year"),
        (F.col("id") % 17 + 1).cast("int").alias("week"),
        F.element_at(F.array(*[F.lit(p) for p in ("QB", "RB", "WR", "TE")]), (F.col("id") % 4 + 1).cast("int")).alias("pos"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("player"),
        F.lit("T").alias("team"),
        (F.col("id") % 31).cast("double").alias("REC"),
        F.lit(0.0).alias("unused"),
    )
    sinks.write_weekly(rows, path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("order", [(), ("REC",)])
def test_season_plan(weekly, order):
    found = history_model(weekly, LeagueConfig(start_year=2016), key="player", order=order)
    # The season model is written before the seasons are planned, and with ``order`` the heads are too.
    text = plan(found.env) + plan(found.seasons)
    assert "WindowGroupLimit" in text or order
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert slow not in text
    scans = [s for s in re.findall(r"FileScan parquet \[.*?ReadSchema: struct<.*?>", text, re.S) if "REC#" in s and "_whole" not in s]
    assert scans
    for scan in scans:
        assert "unused" not in scan
        assert re.search(r"PartitionFilters: \[.*\(year#\d+ >= 2016\)", scan), scan


def test_only_heads_and_season_totals_are_shuffled(weekly):
    found = history_model(weekly, LeagueConfig(start_year=2016), key="player")
    text = plan(found.env) + plan(found.seasons)
    for exchange in re.finditer(r"Exchange hashpartitioning\(([^)]*)\).*\n([^\n]*)", text):
        below = exchange.group(2)
        assert "WindowGroupLimit" in below or "HashAggregate" in below or "Project" in below, below
    # One exchange by period and position (limited rows), one by period, one by year, one by season.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4


def test_wide_shuffles_salt_the_heads(spark, weekly):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        text = plan(history_model(weekly, LeagueConfig(start_year=2016), key="player").env)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert text.count("WindowGroupLimit") == 4 and "_salt" in text


def test_projection_windows_see_limited_rows(spark):
    df = spark.range(1000).select(
        F.col("id").alias("ord"), F.col("id").cast("string").alias("Player"), F.element_at(F.array(F.lit("RB"), F.lit("QB")), (F.col("id") % 2 + 1).cast("int")).alias("POS"), F.rand(1).alias("AVG")
    )
    found = value_projections(df, LeagueConfig(roster=Roster(SUPERFLEX=1)), "ord", key="ord", tiers=False)
    text = plan(found.env)
    windows = [m.start() for m in re.finditer(r"\bWindow \[", text)]
    limits = [m.start() for m in re.finditer(r"WindowGroupLimit", text)]
    assert windows and limits and max(windows) < max(limits)
    final = plan(found.results)
    assert "CartesianProduct" not in final and "SinglePartition" not in re.sub(r"Subquery.*", "", final, flags=re.S)

"""Which (year, week, position) periods a history still lacks, and filling them from stored pages.

A run writes in this order: the periods' rows, the pages that could not be read, and last the log of loaded periods. A period
counts as loaded only by the log, so one whose run ended early is read again, and its rows are replaced and not doubled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import POSITIONS
from waterline.functions.numeric import to_number
from waterline.functions.text import TEAM_CODES, split_player_team
from waterline.sources import pages as page_tables
from waterline.sources.ingest import rename_map
from waterline.sources.sinks import write_weekly
from waterline.sources.storage import materialise

PERIOD = ("year", "week", "pos")


def expected_periods(
    spark: SparkSession, first_year: int, last_year: int, last_week: int = 17, positions: Sequence[str] = POSITIONS
) -> DataFrame:
    """The full grid of source partitions, generated by nested sequences."""
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"))
        .select("year", F.explode(F.sequence(F.lit(1), F.lit(last_week))).alias("week"))
        .select("year", "week", F.explode(F.array(*[F.lit(p) for p in positions])).alias("pos"))
    )


def missing_periods(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Expected partitions with no loaded row yet; keys may be numbers or their text ("2020", "2020.0").

    The loaded side collapses to its distinct keys map-side, so a partition that holds most of the
    rows costs one key per task.
    """
    keys = loaded.select(
        *[F.expr(f"try_cast(try_cast({key} AS double) AS int)").alias(key) for key in ("year", "week")], F.upper("pos").alias("pos")
    ).distinct()
    return expected.join(keys, list(PERIOD), "left_anti")


def append_rows(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Old and new rows, not deduplicated; columns that either side lacks are NULL."""
    return existing.unionByName(fresh, allowMissingColumns=True)


LOAD_SCHEMA = "year int, week int, pos string, rows long, run string"
QUARANTINE_SCHEMA = "year int, week int, pos string, problem string, run string"
#: Why a page whose table can be read gives no weekly rows.
NO_PLAYER, SHORT_ROWS = "no player column", "rows shorter than the header"


@dataclass(frozen=True)
class WeeklyStore:
    """The tables of a weekly history below one folder: its rows by period, the log of loaded periods, and pages set aside."""

    folder: str

    @property
    def rows(self) -> str:
        return f"{self.folder}/rows"

    def _table(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def loads(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "loads", LOAD_SCHEMA)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self._table(spark, "quarantine", QUARANTINE_SCHEMA)

    def weekly(self, spark: SparkSession) -> DataFrame:
        """Rows of the loaded periods, with the columns of all runs; what an unfinished run left is not among them."""
        kept = self.loads(spark).select(*PERIOD).distinct()
        return spark.read.option("mergeSchema", True).parquet(self.rows).join(kept, list(PERIOD), "left_semi")


def page_cells(chosen: DataFrame, html: str) -> DataFrame:
    """(period, headers, cells of every row, problem) of every page; a page with a problem has no rows."""
    parsed = page_tables.parsed_pages(chosen, PERIOD, html)
    rows = F.transform("rows", lambda markup: F.slice(page_tables.cell_texts(markup), F.lit(1), F.size("headers")))
    cells = parsed.select(*PERIOD, "headers", "problem", F.filter(rows, lambda r: F.size(r) > 0).alias("cells"))
    longest = F.array_max(F.transform("cells", lambda r: F.size(r)))
    problem = F.coalesce(
        F.col("problem"),
        F.when(~F.array_contains("headers", "Player"), NO_PLAYER),
        F.when(longest < F.size("headers"), SHORT_ROWS),
    )
    return cells.select(*PERIOD, "headers", F.when(problem.isNull(), F.col("cells")).alias("cells"), problem.alias("problem"))


def weekly_rows(read: DataFrame, teams: Sequence[str] | None = TEAM_CODES) -> DataFrame:
    """Weekly rows of ``page_cells``: (period, player, team, a number for every stat), named by position and order of headers.

    Layouts are few, so their stat names are joined to the rows as an array by a broadcast; where two headers of a
    page have the same name the first counts.
    """
    spark = read.sparkSession
    found = page_tables.layouts(read.filter("problem IS NULL"), ["pos"])
    named = []
    for layout in found:
        renames = rename_map(layout["pos"], layout["headers"])
        named.append((layout["pos"], layout["headers"], [renames.get(h, h) for h in layout["headers"]]))
    stats = list(dict.fromkeys(n for _, _, names in named for n in names if n not in ("Player", "Team")))
    known = F.broadcast(spark.createDataFrame(named, "pos string, headers array<string>, names array<string>"))
    rows = read.join(known, ["pos", "headers"]).select(*PERIOD, "names", F.explode("cells").alias("cells"))

    def cell(name: str) -> Column:
        return F.get("cells", (F.array_position("names", F.lit(name)) - 1).cast("int"))

    split = rows.select(*PERIOD, "names", "cells", split_player_team(cell("Player"), teams).alias("who"))
    return split.select(
        *PERIOD, F.col("who.player").alias("Player"), F.col("who.team").alias("Team"), *[to_number(cell(s)).alias(s) for s in stats]
    )


def backfill_from_pages(
    pages: DataFrame, store: WeeklyStore, expected: DataFrame, run: str, html: str = "html", teams: Sequence[str] | None = TEAM_CODES
) -> None:
    """Load the expected periods that ``store`` lacks from stored ``pages`` (year, week, pos, ``html``).

    Pages of one period are parts of it. A period with a page that cannot be read is set aside whole, with the problem of each
    such page, and is tried again by the next run; a period without rows is not loaded either. Only pages of lacking periods are
    read. Other columns of ``pages`` are not stats and are left out.
    """
    spark = pages.sparkSession
    lacking = missing_periods(expected, store.loads(spark))
    typed = pages.select(F.col("year").cast("int").alias("year"), F.col("week").cast("int").alias("week"), F.upper("pos").alias("pos"), html)
    read = materialise(page_cells(typed.join(lacking, list(PERIOD), "left_semi"), html))
    failed = read.filter("problem IS NOT NULL").select(*PERIOD, "problem")
    good = read.join(failed.select(*PERIOD).distinct(), list(PERIOD), "left_anti")

    write_weekly(weekly_rows(good, teams), store.rows)
    failed.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{store.folder}/quarantine")
    sizes = good.groupBy(*PERIOD).agg(F.sum(F.size("cells")).cast("long").alias("rows")).filter("rows > 0")
    sizes.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{store.folder}/loads")

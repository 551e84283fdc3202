"""Stand-in inputs that Spark derives from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import LeagueConfig, Roster, ScoringWeights
from waterline.operators.ranking import number_rows

# Position by part type, market segment and event type; other values stay as they are.
PART_POSITIONS = {"ECONOMY": "QB", "LARGE": "RB", "MEDIUM": "WR", "STANDARD": "TE"}
SEGMENT_POSITIONS = {"AUTOMOBILE": "QB", "BUILDING": "RB", "FURNITURE": "WR", "HOUSEHOLD": "TE"}
EVENT_POSITIONS = {"view": "QB", "click": "RB", "purchase": "WR", "signup": "TE"}
# Team codes and cell layouts of the text fixtures.
TEXT_TEAMS = ("KC", "DET", "SF", "LAR", "NE", "GB", "TB", "BUF")

WEIGHTS = ScoringWeights(
    rec=0.5, rec_yds=0.0001, rec_td=0.0, rush_yds=0.0, rush_td=0.0, pass_yds=0.0, pass_td=0.0, ints=-2.0, fl=-2.0
)
WEEKLY_LEAGUE = LeagueConfig(weeks=12, start_year=1995, scoring=WEIGHTS)
SUPERFLEX_LEAGUE = LeagueConfig(weeks=12, start_year=1995, scoring=WEIGHTS, roster=Roster(SUPERFLEX=1))
SMOKE_LEAGUE = LeagueConfig(teams=2, weeks=12, start_year=1995, scoring=WEIGHTS)
EVENT_LEAGUE = LeagueConfig(weeks=5, start_year=2024, roster=Roster(SUPERFLEX=1))
POOL_LEAGUE = LeagueConfig(projection_year=1998)
CLAMPED_LEAGUE = LeagueConfig.clamped(25.7, projection_year=1998)
# Periods of the stored pages that cannot be read at first, or never.
BAD_PERIOD, UNNAMED_PERIOD = (1996, 2, "WR"), (1997, 3, "QB")
DUPLICATE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recode(column: str, names: dict[str, str]) -> Column:
    chain = F
    for old, new in names.items():
        chain = chain.when(F.col(column) == old, new)
    return chain.otherwise(F.col(column))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_brand", recode("p_type", PART_POSITIONS).alias("Pos"))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture W: one row per part and month, stats summed over its line items."""
    facts = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Week"))
        .agg(
            F.sum("l_quantity").alias("REC"),
            F.sum("l_extendedprice").alias("ReceivingYDS"),
            (F.sum("l_discount") * 10).alias("INTS"),
            (F.sum("l_tax") * 10).alias("FL"),
        )
    )
    named = facts.join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    return named.select(
        F.col("p_partkey").cast("string").alias("Player"),
        F.col("p_brand").alias("Team"),
        "Pos", "Year", "Week", "REC", "ReceivingYDS", "INTS", "FL",
    )


def weekly_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture W ungrouped: each line item is a row, so a part may have several rows in a month."""
    items = table(spark, sf_dir, "lineitem").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    return items.select(
        F.col("p_partkey").cast("string").alias("Player"),
        F.col("p_brand").alias("Team"),
        "Pos",
        F.year("l_shipdate").alias("Year"),
        F.month("l_shipdate").alias("Week"),
        F.col("l_quantity").alias("REC"),
        F.col("l_extendedprice").alias("ReceivingYDS"),
        (F.col("l_discount") * 10).alias("INTS"),
        (F.col("l_tax") * 10).alias("FL"),
        *DUPLICATE_ORDER,
    )


#: Header of the written facts; the second YDS is a surplus column that must not be taken for the first.
CSV_HEADER = "Player,Team,Pos,Year,Week,REC,YDS,INTS,YDS,FL"


def write_weekly_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The facts of ``weekly_duplicates`` as CSV files in input order, each with a header that repeats a name."""
    facts = weekly_duplicates(spark, sf_dir).orderBy(*DUPLICATE_ORDER)
    cells = ("Player", "Team", "Pos", "Year", "Week", "REC", "ReceivingYDS", "INTS", "l_orderkey", "FL")
    lines = facts.select(F.concat_ws(",", *[F.col(c).cast("string") for c in cells]).alias("value"))

    def with_header(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [CSV_HEADER]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

    lines.mapInArrow(with_header, "value string").write.text(path)


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: scored facts (year, week, id, player, pos, fpts) of users by event type and ISO week."""
    events = table(spark, sf_dir, "events").select(
        F.year("ts").alias("year"),
        F.weekofyear("ts").alias("week"),
        F.col("user_id").cast("string").alias("player"),
        recode("event_type", EVENT_POSITIONS).alias("pos"),
        "value",
    )
    grouped = events.groupBy("year", "week", "player", "pos").agg(F.round(F.sum("value"), 4).alias("fpts"))
    return grouped.withColumn("id", F.concat_ws("-", "player", "pos"))


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture P: customers as projected players; the average stays NULL without orders."""
    spend = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sum(_cents("o_totalprice")).alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return customer.join(spend, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("Name"),
        F.col("n_name").alias("TEAM"),
        recode("c_mktsegment", SEGMENT_POSITIONS).alias("position"),
        # Whole cents per order, so that both engines hold the same double.
        (F.expr("cents div n").cast("double") / 1e6).alias("FPTS/G"),
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture P's draft order: customers with at least five orders, most orders first."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("o_custkey").asc()]
    ranked = number_rows(counts.filter("n >= 5"), order, "Rank")
    return ranked.select(
        F.col("o_custkey").alias("custkey"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"), F.lit(" KC (7)")).alias("Player Team (Bye)"),
        "Rank",
        F.col("Rank").cast("double").alias("AVG"),
    )


def stat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat pages: one per part and year with a table row per month; excluded types get no stat table.

    Every third month's row holds a table in a cell. Comments and scripts hold tables and rows that are none.
    """
    cell = lambda text: F.concat(F.lit("<td>"), text, F.lit("</td>"))
    inner = F.lit("<table><thead><tr><th>n</th></tr></thead><tbody><tr><td> in </td></tr></tbody></table>")
    months = (
        weekly(spark, sf_dir)
        .groupBy(F.col("Player").alias("player"), F.col("Year").alias("year"), F.col("Pos").alias("pos"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("Week", F.col("REC").cast("bigint").alias("qty"), F.round("INTS", 1).cast("string").alias("d"))
                )
            ).alias("months")
        )
    )
    rows = F.transform(
        "months",
        lambda m: F.concat(
            F.lit("<tr class='r'>\n "),
            cell(m["Week"].cast("string")),
            cell(F.concat(F.lit(" <b> "), m["qty"].cast("string"), F.lit(" </b> "))),
            cell(F.when(m["Week"] % 3 == 0, F.concat(F.lit(" a &amp; b "), inner)).otherwise(" a &amp; <!-- no --> b ")),
            cell(m["d"]),
            cell(F.lit("surplus")),
            F.lit("</tr>"),
        ),
    )
    table_id = F.when(F.col("pos").isin(*PART_POSITIONS.values()), "data").otherwise("other")
    html = F.concat(
        F.lit("<html><body><!-- <table id=\"data\"><thead><tr><th>no</th></tr></thead><tbody><tr><td>no</td></tr></tbody></table> -->"),
        F.lit("<script>var t = '<table id=\"data\"><tbody>';</script><table class=\"<table id='data'>\" id=\""), table_id,
        F.lit("\"><thead><tr><th>Week</th><th> QTY </th><th></th><th><span>QTY</span></th></tr></thead><tbody>"),
        F.array_join(rows, "\n<!-- <tr><td>gone</td></tr> -->"), F.lit("<tr></tr></tbody></table></body></html>"),
    )
    return months.select("player", "year", html.alias("html"))


def weekly_pages(spark: SparkSession, sf_dir: str, mended: bool) -> DataFrame:
    """Stored stat pages (year, week, pos, fetched, html): a period's players, a page for every thousand part numbers.

    One page of ``BAD_PERIOD`` has no stat table unless ``mended``; those of ``UNNAMED_PERIOD`` never name the players.
    """
    cell = lambda text: F.concat(F.lit("<td>"), text, F.lit("</td>"))
    team = F.element_at(F.array(*[F.lit(t) for t in TEXT_TEAMS]), (F.col("key") % len(TEXT_TEAMS) + 1).cast("int"))
    facts = weekly(spark, sf_dir).filter(F.col("Pos").isin(*PART_POSITIONS.values())).withColumn("key", F.col("Player").cast("int"))
    row = F.concat(
        F.lit("<tr>"), cell(F.concat(F.lit("<a href='#'>Part "), "Player", F.lit(" ("), team, F.lit(")</a>"))),
        cell(F.floor("REC").cast("string")), cell(F.format_number(F.floor("ReceivingYDS"), 0)), cell(F.round("INTS", 1).cast("string")),
        cell(F.lit("-")), cell(F.lit("1")), F.lit("</tr>"),
    )
    part = F.floor(F.col("key") / 1000).alias("part")
    listed = facts.groupBy(F.col("Year").alias("year"), F.col("Week").alias("week"), F.col("Pos").alias("pos"), part).agg(
        F.array_sort(F.collect_list(row)).alias("rows")
    )
    at = lambda period: (F.col("year") == period[0]) & (F.col("week") == period[1]) & (F.col("pos") == period[2])
    table_id = F.when(at(BAD_PERIOD) & (F.col("part") == 0) & F.lit(not mended), "datum").otherwise("data")
    who = F.when(at(UNNAMED_PERIOD), "Who").otherwise("Player")
    html = F.concat(
        F.lit("<table id='nav'><tr><td>x</td></tr></table><table id='"), table_id, F.lit("'><thead><tr><th>"), who,
        F.lit("</th><th>REC</th><th>YDS</th><th>INT</th><th>FL</th><th>G</th></tr></thead><tbody><!-- <tr><td>ad</td></tr> -->"),
        F.array_join("rows", "\n"), F.lit("</tbody></table>"),
    )
    return listed.select("year", "week", F.lower("pos").alias("pos"), F.lit("stored").alias("fetched"), html.alias("html"))


def projection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored projection pages (pos, page, html) of five hundred part numbers each, in their order."""
    cell = lambda text: F.concat(F.lit("<td>"), text, F.lit("</td>"))
    number = cell(F.concat(F.lit("<span>"), "cell", F.lit("</span>")))
    row = F.concat(F.lit("<tr>"), cell(F.concat(F.lit("<a>"), "text", F.lit("</a>"))), number, number, number, number, F.lit("</tr>"))
    listed = source_text(spark, sf_dir).groupBy("pos", F.floor(F.col("p_partkey") / 500).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("row")))).alias("rows")
    )
    head = "<table id='data'><thead><tr><th>Player</th><th>YDS</th><th>TDS</th><th>YDS</th><th>FL</th></tr></thead><tbody>"
    html = F.concat(F.lit(head), F.array_join("rows.row", ""), F.lit("</tbody></table>"))
    return listed.select("pos", "page", html.alias("html"))


def letters(key: str) -> Column:
    """A number as letters, for keys that keep letters only."""
    return F.translate(F.col(key).cast("string"), "0123456789", "abcdefghij")


def named_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture P with names in letters, season totals in place of averages, bounds, and positions with digits."""
    total = F.col("`FPTS/G`") * 17
    return projections(spark, sf_dir).select(
        "custkey", F.concat(F.lit("CUSTOMER-"), letters("custkey"), F.lit(" "), "custkey").alias("Name"), "TEAM",
        F.concat(F.lower("position"), F.lit("7")).alias("position"), total.alias("FPTS"), (total + 17).alias("FPTS High"), (total - 8.5).alias("FPTS Low"),
    )


def market_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored market pages (page, html) of a hundred ranks each."""
    cell = lambda text: F.concat(F.lit("<td>"), text, F.lit("</td>"))
    team = F.element_at(F.array(*[F.lit(t) for t in TEXT_TEAMS]), (F.col("custkey") % len(TEXT_TEAMS) + 1).cast("int"))
    rows = market(spark, sf_dir).select(
        F.floor(F.col("Rank") / 100).alias("page"),
        F.concat(
            F.lit("<tr>"), cell(F.col("Rank").cast("string")),
            cell(F.concat(F.lit("Customer "), letters("custkey"), F.lit(" "), team, F.lit(" (7)"))),
            cell(F.lit("RB12")), cell(F.concat(F.col("Rank").cast("string"), F.lit(".5"))), F.lit("</tr>"),
        ).alias("row"),
    )
    head = "<table id=data><thead><tr><th>Rank</th><th>Player Team (Bye)</th><th>POS</th><th>AVG</th></tr></thead><tbody>"
    html = F.concat(F.lit(head), F.array_join(F.collect_list("row"), ""), F.lit("</tbody></table>"))
    return rows.groupBy("page").agg(html.alias("html"))


def mixed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names of mixed case and with accents; a few are blank or missing."""
    name = F.when(F.col("p_size") % 5 == 0, F.replace("p_name", F.lit("e"), F.lit("é"))).otherwise(F.col("p_name"))
    cased = F.when(F.col("p_size") % 3 == 0, F.initcap(name)).when(F.col("p_size") % 3 == 1, F.upper(name)).otherwise(name)
    rows = table(spark, sf_dir, "part")
    return rows.select("p_partkey", F.when(F.col("p_partkey") % 97 == 0, F.lit(None)).when(F.col("p_partkey") % 89 == 0, "").otherwise(cased).alias("name"))


def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text cells out of part and lineitem: combined names in five layouts, run-together numbers."""
    totals = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    part = table(spark, sf_dir, "part")
    team = F.element_at(F.array(*[F.lit(t) for t in TEXT_TEAMS]), (F.col("p_size") % len(TEXT_TEAMS) + 1).cast("int"))
    layout = F.col("p_partkey") % 5
    name = F.col("p_name")
    text = (
        F.when(layout == 0, F.concat(name, team, F.lit("highlow")))
        .when(layout == 1, F.concat(name, F.lit(" II"), team, F.lit("(7)")))
        .when(layout == 2, F.concat(name, F.lit(" ("), team, F.lit(")")))
        .when(layout == 3, F.concat(name, F.lit("  "), team, F.lit(" (11)")))
        .otherwise(F.concat(name, F.lit(" (Rookie)")))
    )

    def grouped(number: Column) -> Column:
        thousands = F.concat(
            F.floor(number / 1000).cast("string"),
            F.lit(","),
            F.lpad((number % 1000).cast("string"), 3, "0"),
        )
        return F.when(number >= 1000, thousands).otherwise(number.cast("string"))

    digit = F.concat(F.lit("."), (F.col("p_size") % 10).cast("string"))
    triple = F.concat(grouped(F.col("q")), digit, grouped(F.col("q") + 20), digit, grouped(F.col("q") - 5), digit)
    cell = (
        F.when(F.col("q").isNull(), "-").when(layout == 4, grouped(F.col("q"))).otherwise(triple)
    )
    joined = part.join(totals, F.col("p_partkey") == F.col("l_partkey"), "left")
    return joined.select(
        "p_partkey", "p_size", recode("p_type", PART_POSITIONS).alias("pos"), text.alias("text"), cell.alias("cell"), "q"
    )

"""Writers: result export, source tables, partitioned weekly history and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Export columns in order, as (header, result column).
EXPORT_COLUMNS = (
    ("Year", "year"), ("Overall Rank", "overall_rank"), ("Player", "player"), ("Team", "team"), ("Pos", "pos"),
    ("Pos Rank", "pos_rank_label"), ("WAR", "war"), ("Historical WAR", "historical_war"),
    ("Delta vs Historical", "delta_vs_historical"), ("ADP", "adp"), ("ADP Discount", "adp_discount"),
    ("Value", "value"), ("Tier", "tier"), ("AVG", "avg"), ("FPTS", "fpts"), ("Flex WAR", "flex_war"),
    ("SuperFlex WAR", "superflex_war"),
)


def export_frame(results: DataFrame) -> DataFrame:
    return results.select(*[F.col(column).alias(header) for header, column in EXPORT_COLUMNS])


def export_results(results: DataFrame, path: str) -> None:
    """Results in overall-rank order as RFC 4180 CSV files, missing values blank."""
    ordered = export_frame(results).orderBy("Overall Rank")
    ordered.write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="", escape='"')


def write_table_csv(df: DataFrame, path: str) -> None:
    """A projection or market table as CSV with minimal quoting."""
    df.write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="", escape='"')


def write_weekly(weekly: DataFrame, path: str) -> None:
    """Weekly rows as Parquet by year, week and position; only the periods present are replaced.

    Rows are laid out by period so each period has few files. It is a rebalance, so adaptive execution splits a
    heavy period over tasks and joins light ones.
    """
    (
        weekly.hint("rebalance", F.col("year"), F.col("week"), F.col("pos"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "week", "pos")
        .parquet(path)
    )


def append_run_log(entries: DataFrame, path: str) -> None:
    """Add (key, value, updated_at) entries; nothing is rewritten, so there is no corrupt state to merge."""
    entries.select("key", "value", "updated_at").write.mode("append").parquet(path)


def latest_run_values(log: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Current value per key, the newest entry winning."""
    order = F.struct("updated_at", tie_break) if tie_break else F.col("updated_at")
    return log.groupBy("key").agg(
        F.max_by("value", order).alias("value"), F.max("updated_at").alias("updated_at")
    )


def compact_run_log(spark: SparkSession, path: str, compacted: str) -> None:
    """Write the current value of every key of the log at ``path`` as a new log, whose readers see the same values.

    The old log is left as it is until the caller drops it, so a run that ends early loses nothing.
    """
    latest_run_values(spark.read.parquet(path), tie_break="value").write.parquet(compacted)

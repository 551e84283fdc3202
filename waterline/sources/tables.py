"""CSV, JSON and Parquet readers with the fallbacks of the two optional sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.sources.storage import materialise, small

WEEKLY_SCHEMA = (
    "Year string, Week string, Player string, Team string, Pos string, PassingYDS string, PassingTD string, "
    "INTS string, RushingYDS string, RushingTD string, REC string, ReceivingYDS string, ReceivingTD string, FL string"
)
MARKET_SCHEMA = "Year string, Player string, Team string, `ADP Rank` string, POS string, ADP string"
MANIFEST_SCHEMA = (
    "updated_at string, current_projections string, current_adp string, historical_weekly string, "
    "adp_scoring string, season_year int, historical_start_year int, historical_end_year int"
)


def header_names(cells: Sequence[str | None]) -> list[str]:
    """Column names of a header row: the n-th repeat of a name gets the suffix _n, a blank one its place."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for at, cell in enumerate(cells):
        name = cell or f"_c{at}"
        seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}_{seen[name]}" if seen[name] else name)
    return names


def with_input_order(df: DataFrame, name: str) -> DataFrame:
    """Add the place of every row in the input, one 64-bit number: files by path, then by place in the file.

    ``df`` must come straight from files. The scan numbers the rows of its blocks; the blocks themselves, of which there is
    one per task at least, are listed by a scan of their own, counted, and joined.
    """
    place, row_bits = f"_{name}_block", 33
    block = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    tagged = df.select("*", block.alias(place), F.monotonically_increasing_id().alias(name))
    blocks = materialise(df.select(block.alias(place)).distinct())
    numbered = blocks.withColumn("_at", F.row_number().over(Window.orderBy(place)).cast("long"))
    within = F.col(name).bitwiseAND(F.lit((1 << row_bits) - 1))
    joined = tagged.join(small(numbered, blocks.count()), place)
    return joined.withColumn(name, F.shiftleft("_at", row_bits) + within).drop(place, "_at")


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, order: str | None = None) -> DataFrame:
    """All-string CSV with a header row; blank lines are skipped and repeated headers numbered (TD, TD_1).

    Quoted cells may span lines, for which each file must be read by one task: fine for small tables.
    ``multi_line=False`` lets large files be split when no cell holds a line break. ``order`` names
    a column for the place of a row in the input.
    """
    settings = {"inferSchema": False, "multiLine": multi_line, "escape": '"'}
    first = spark.read.csv(path, header=False, **settings).head()
    if first is None:
        return spark.read.csv(path, header=True, **settings)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header_names(list(first))])
    rows = spark.read.csv(path, header=True, schema=schema, **settings)
    return rows if order is None else with_input_order(rows, order)


def read_json_document(spark: SparkSession, path: str, schema: str = MANIFEST_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def read_optional(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """The CSV at ``path``, or an empty table of ``schema`` when there is none."""
    try:
        return read_csv(spark, path, multi_line)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class ProjectionInputs:
    projections: DataFrame
    market: DataFrame
    is_fallback: bool


def read_projection_inputs(spark: SparkSession, projections: str, market: str, fallback: str) -> ProjectionInputs:
    """Primary projections with their market table; if either is missing, the fallback and no market."""
    try:
        return ProjectionInputs(read_csv(spark, projections), read_csv(spark, market), False)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return ProjectionInputs(read_csv(spark, fallback), spark.createDataFrame([], MARKET_SCHEMA), True)


def read_weekly_history(spark: SparkSession, path: str) -> DataFrame:
    """Weekly history as CSV (names and numbers on one line each); empty when not loaded yet."""
    return read_optional(spark, path, WEEKLY_SCHEMA, multi_line=False)


def read_weekly_table(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned Parquet history written by ``sinks.write_weekly``, to resume from."""
    return spark.read.parquet(path)


def manifest_time(manifest: DataFrame) -> DataFrame:
    """Manifest rows with ``updated_at`` as a timestamp, NULL when it cannot be read."""
    return manifest.withColumn("updated_at", F.try_to_timestamp(F.col("updated_at")))


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """(key, value, updated_at) of every manifest document below ``path``, a file each, to go into the run log.

    A document counts as of its own ``updated_at``, or of its file's time without one that can be read. One that is damaged
    has no entries, and does no harm to the others. Values that are no text come as their JSON text.
    """
    documents = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_modification_time").alias("_written"))
    parsed = documents.select(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("entries"), "_written")
    stamp = F.coalesce(F.try_to_timestamp(F.col("entries")["updated_at"]), F.col("_written")).cast("timestamp_ntz")
    return parsed.select(F.explode("entries").alias("key", "value"), stamp.alias("updated_at")).filter("key <> 'updated_at' AND value IS NOT NULL")

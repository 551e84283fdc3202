"""Row numbers over groups of any size.

A window without a natural partition, or with a handful of huge ones, sorts its rows in as many
tasks as there are groups. Here the rows are range-partitioned on the whole sort order instead, so
one group spreads over many tasks; the position in a partition plus the number of the group's rows
in earlier partitions is the row number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.sources.storage import materialise, small

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33
# Shuffle partitions per salted part of a group in ``best_rows``.
_TASKS_PER_PART = 64
# The engine limits the rows of a group before the exchange only up to this many.
_LIMIT_SETTING, _LIMIT_DEFAULT = "spark.sql.optimizer.windowGroupLimitThreshold", 1000


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_rows(
    df: DataFrame, order: Sequence[Column], out: str, within: Sequence[str] = (), groups: int | None = None
) -> DataFrame:
    """Add ``out`` = 1, 2, ... in ``order`` inside each (non-null) ``within`` group.

    ``order`` must end in a key that makes it total. ``groups`` is the caller's bound on the number
    of groups; without it the offsets are written and counted before they may be broadcast. The
    laid-out rows are materialised in the shared folder, because the two reads of them below must
    see the same partitions even when a task is run again.
    """
    width = shuffle_width(df)
    groups = groups if within else 1
    layout = [F.col(g).asc() for g in within] + list(order)
    laid = materialise(
        df.repartitionByRange(width, *layout)
        .sortWithinPartitions(*layout)
        .withColumn("_slot", F.monotonically_increasing_id())
    ).withColumn("_piece", F.shiftright("_slot", _PARTITION_BIT))

    pieces = laid.groupBy(*within, "_piece").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"))
    earlier = Window.partitionBy(*(within or [F.lit(0)])).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    offsets = pieces.select(*within, "_piece", shift.alias("_shift"))
    # Each partition boundary splits at most one group, so there are at most width + groups pieces.
    if groups is None:
        offsets = materialise(offsets)
    side = small(offsets, offsets.count() if groups is None else width + groups)
    return (
        laid.join(side, [*within, "_piece"])
        .withColumn(out, (F.col("_slot") + F.col("_shift")).cast("int"))
        .drop("_slot", "_piece", "_shift")
    )


def _running_counts(codes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How many rows of its own group each row is, counting on from ``before``, which is updated."""
    order = np.argsort(codes, kind="stable")
    sizes = np.bincount(codes, minlength=len(before))
    starts = np.cumsum(sizes) - sizes
    numbers = np.empty(len(codes), dtype=np.int64)
    numbers[order] = np.arange(1, len(codes) + 1) - np.repeat(starts - before, sizes)
    before += sizes
    return numbers


def number_rows_by(df: DataFrame, order: Sequence[Column], outs: Mapping[str, str | None], groups: int) -> DataFrame:
    """Several row numbers in one ``order``: ``outs`` names each with the column whose groups it counts in, None for all rows.

    One layout serves them all, the overall order: a task counts every group's rows as they pass in order, and a
    (piece, group) table of the counts shifts them. ``groups`` is the caller's bound on the groups of a column, so a task
    holds that many counters and the tables have at most that many rows a piece. Null is a group like others.
    """
    width = shuffle_width(df)
    laid = df.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("_piece", F.spark_partition_id())
    columns = {out: within for out, within in outs.items()}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {out: {} for out in columns}
        before = {out: np.zeros(0, dtype=np.int64) for out in columns}
        for batch in batches:
            added = []
            for out, within in columns.items():
                if within is None:
                    codes = np.zeros(batch.num_rows, dtype=np.int64)
                    seen[out].setdefault(None, 0)
                else:
                    coded = batch.column(within).dictionary_encode(null_encoding="encode")
                    own = [seen[out].setdefault(g, len(seen[out])) for g in coded.dictionary.to_pylist()]
                    codes = np.array(own, dtype=np.int64)[coded.indices.to_numpy()] if own else np.zeros(0, dtype=np.int64)
                before[out] = np.pad(before[out], (0, len(seen[out]) - len(before[out])))
                added.append(pa.array(_running_counts(codes, before[out])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *columns])

    schema = T.StructType([*laid.schema.fields, *[T.StructField(out, T.LongType()) for out in columns]])
    numbered = materialise(laid.mapInArrow(count, schema))
    for out, within in columns.items():
        keys = [within] if within else []
        totals = numbered.groupBy(*keys, "_piece").agg(F.max(out).alias("_n"))
        earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        shift = totals.select(
            F.col("_piece").alias("_at"), *[F.col(k).alias("_group") for k in keys], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift")
        )
        on = F.col("_piece") == F.col("_at")
        if within:
            on = on & F.col(within).eqNullSafe(F.col("_group"))
        numbered = numbered.join(small(shift, width * (groups if within else 1)), on)
        numbered = numbered.withColumn(out, (F.col(out) + F.col("_shift")).cast("int")).drop("_at", "_group", "_shift")
    return numbered.drop("_piece")


def best_rows(
    df: DataFrame,
    order: Sequence[Column],
    limit: int,
    within: Sequence[str],
    out: str,
    fan_in: int | None = None,
) -> DataFrame:
    """Only the first ``limit`` rows of each group, numbered by ``out``.

    A limit above the engine's threshold for this has no such short cut; the rows are then numbered by
    ``number_rows``, which spreads a group over tasks, and cut afterwards.

    Spark limits each group inside the map tasks, before the exchange, so at most ``limit`` rows
    per group and task are shuffled however large a group is. With very many map tasks even that is
    a lot for one reducer, so the limit is first applied to ``fan_in`` salted parts of each group
    (chosen from the shuffle width unless given; 1 leaves the step out).
    """
    if limit > int(df.sparkSession.conf.get(_LIMIT_SETTING, str(_LIMIT_DEFAULT))):
        return number_rows(df, order, out, within=within).filter(F.col(out) <= limit)
    fan_in = max(1, shuffle_width(df) // _TASKS_PER_PART) if fan_in is None else fan_in
    group = list(within) or [F.lit(0)]

    def first(rows: DataFrame, keys: list) -> DataFrame:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
            F.col(out) <= limit
        )

    if fan_in > 1:
        # Hashed from the row itself, so a task that runs again salts it alike. Its arrays and structs are left out where
        # there are plain columns: a caller that does not use them need not make them for the salt.
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType))]
        salt = F.pmod(F.xxhash64(*(plain or df.columns)), F.lit(fan_in))
        df = first(df.withColumn("_salt", salt), [*group, "_salt"]).drop(out, "_salt")
    return first(df, group)

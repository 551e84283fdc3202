"""Contiguous shards of near-equal bytes from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.sources.storage import materialise

#: A group of equal texts no larger than this part of a shard is not cut.
SLACK = 0.002
_OWN = ("_piece", "_upto", "_row")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def byte_shards(
    documents: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", slack: float = SLACK,
    parts: int | None = None, keep_text: bool = True,
) -> DataFrame:
    """All rows and columns of ``documents`` with size, shard (0 to shards - 1) and slot (0, 1, ... in each shard).

    The rows are laid out by (digest of the text, doc_id), so equal texts are neighbours, and this order
    is cut where the running sum of sizes passes each multiple of total / shards. A row belongs to the
    shard in which it starts. A cut that would fall inside a group of equal texts of at most ``slack`` of
    a shard moves to the group's start; larger groups are cut, which no single key can prevent.

    One range exchange sorts the rows; a task adds up its own partition while it writes it. The totals
    of partitions (one row each) give every partition its offset. Only the ``shards`` - 1 rows at the cuts come to
    the driver. Rows that are equal in all columns may trade places. Null and empty texts have
    size 1; null ids come first among equal texts. Columns of ``documents`` named size, shard or slot are replaced.
    Without ``keep_text`` the text itself is not moved and not returned.
    """
    rows = documents.drop("size", "shard", "slot", "_digest", *_OWN)
    # Hashed only where the id leaves a tie, but part of every sort key so that the order is total.
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c not in (doc_id, text)]) if len(rows.columns) > 2 else F.lit(0)
    rows = rows.withColumns({"size": text_bytes(F.col(text)), "_digest": F.md5(F.coalesce(F.col(text), F.lit(""))), "_rest": rest})
    if not keep_text:
        rows = rows.drop(text)
    width = parts or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_digest").asc(), F.col(doc_id).asc_nulls_first(), F.col("_rest").asc()]
    laid = rows.repartitionByRange(width, *order).sortWithinPartitions(*order).drop("_rest")
    laid = laid.withColumn("_piece", F.spark_partition_id())

    def running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto, row = 0, 0
        for batch in batches:
            sums = upto + np.cumsum(batch.column("size").to_numpy())
            numbers = row + np.arange(batch.num_rows)
            if batch.num_rows:
                upto, row = int(sums[-1]), int(numbers[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.int64()), pa.array(numbers, pa.int64())],
                names=[*batch.schema.names, "_upto", "_row"],
            )

    schema = T.StructType([*laid.schema.fields, T.StructField("_upto", T.LongType()), T.StructField("_row", T.LongType())])
    laid = materialise(laid.mapInArrow(running, schema))

    totals = laid.groupBy("_piece").agg(F.max("_upto").alias("bytes"), F.max("_row").alias("last"))
    # As many rows as the layout has partitions, so the window's single task and the broadcast stay small.
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_piece",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_before"),
        F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("_rows_before"),
    )
    placed = laid.join(F.broadcast(offsets), "_piece")
    placed = placed.withColumns(
        {"_start": F.col("_before") + F.col("_upto") - F.col("size"), "_number": F.col("_rows_before") + F.col("_row")}
    )
    cuts = _cuts(placed, totals.agg(F.sum("bytes")).first()[0] or 0, shards, slack)
    shard, first = F.lit(0), F.lit(0)
    for k, (start, number) in enumerate(cuts, 1):
        shard = F.when(F.col("_start") >= start, k).otherwise(shard)
        first = F.when(F.col("_start") >= start, number).otherwise(first)
    return placed.select(
        *[f"`{c}`" for c in rows.columns if c not in ("_digest", "_rest")],
        shard.cast("int").alias("shard"),
        (F.col("_number") - first).cast("long").alias("slot"),
    )


def _cuts(placed: DataFrame, total: int, shards: int, slack: float) -> list[tuple[int, int]]:
    """Where each shard but the first starts: (bytes before it, rows before it)."""
    targets = [-(-k * total // shards) for k in range(1, shards)]
    end = F.col("_start") + F.col("size")
    # The row that passes each target; the shard starts after it.
    inside = F.array(*[F.when((F.col("_start") < t) & (end >= t), F.lit(k)) for k, t in enumerate(targets)])
    crossing = (
        placed.select("_digest", "_start", "_number", "size", F.explode(F.array_compact(inside)).alias("k"))
        .orderBy("k")
        .collect()
    )
    if not crossing:
        return []
    groups = {
        r["_digest"]: r
        for r in placed.filter(F.col("_digest").isin(*{r["_digest"] for r in crossing}))
        .groupBy("_digest")
        .agg(F.sum("size").alias("bytes"), F.min("_start").alias("start"), F.min("_number").alias("number"))
        .collect()
    }
    found = []
    for row in crossing:
        group = groups[row["_digest"]]
        after = (row["_start"] + row["size"], row["_number"] + 1)
        whole = group["bytes"] <= slack * total / shards
        if whole and group["start"] + group["bytes"] > after[0]:
            found.append((group["start"], group["number"]))
        else:
            found.append(after)
    return found

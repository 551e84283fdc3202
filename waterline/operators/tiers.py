"""Tiers: one-dimensional k-means over several k at once, scored by silhouette.

The values are reduced to a line: distinct values in order, with the count and sum of all below. Clusters of a line are
intervals, so a Lloyd round needs no values, only the line's running totals at the places where the nearest center changes,
at most 741 over all k. An index of the line's blocks tells each place's block, and a round reads those blocks alone; where a
block holds one value, as on lines of up to ``MOST_BLOCKS`` values, the index knows the totals itself. Sums are whole numbers of
``RANK_DIGITS`` places, so a difference of running totals is exact and the result does not hang on the order of sums.

The silhouette needs no pairs either: the distance to another cluster is the distance to its mean, and the own cluster's
follows from counts and sums below the value.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.functions.numeric import RANK_DIGITS, nearest, rank_key
from waterline.operators.ranking import number_rows, shuffle_width
from waterline.sources.storage import materialise, small

# Fixed values.
FEWEST_VALUES = 4
K_LOW, K_HIGH, K_GROWTH = 30, 48, 2.5
MAX_ROUNDS = 50
SMALLEST_SCALE = 1e-6
NO_SCORE = -1.0
SCORE_DIGITS = 10
UNIT = 10.0**RANK_DIGITS
#: Rows of the index that comes to the driver, at most.
MOST_BLOCKS = 1 << 16
#: Ranges of blocks in the condition of one read, at most.
MOST_RANGES = 32


def k_range(n: int) -> range:
    """The cluster counts tried for ``n`` values; empty below four values."""
    if n < FEWEST_VALUES:
        return range(0)
    low = min(K_LOW, n)
    high = min(K_HIGH, max(low, math.ceil(math.sqrt(n) * K_GROWTH)), n)
    return range(low, high + 1)


def balanced_tier(rank: Column, n: Column | int, tiers: int) -> Column:
    """Tier of a 1-based rank when ``n`` ranks are spread evenly over ``tiers``."""
    n = F.lit(n) if isinstance(n, int) else n
    share = (rank - 1).cast("double") / n.cast("double") * F.lit(float(tiers))
    return F.least(F.lit(tiers), F.floor(share).cast("int") + 1)


def _assign(values: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Nearest center of each value, the lowest index on ties; centers in any order."""
    order = np.lexsort((np.arange(len(centers)), centers))
    line = centers[order]
    # Equal centers: only the first in index order can win.
    firsts = np.concatenate(([True], line[1:] != line[:-1]))
    order, line = order[firsts], line[firsts]
    right = np.clip(np.searchsorted(line, values), 0, len(line) - 1)
    left = np.clip(right - 1, 0, None)
    gap_left, gap_right = np.abs(values - line[left]), np.abs(values - line[right])
    take_left = (gap_left < gap_right) | ((gap_left == gap_right) & (order[left] < order[right]))
    return np.where(take_left, order[left], order[right])


def _balanced_or(conditions: list[Column]) -> Column:
    """A shallow tree, since a chain of hundreds is slow to plan."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


@dataclass(frozen=True)
class Cut:
    """Where the nearest center changes from ``left`` to ``right``; a value between them as near to both goes right if ``to_right``."""

    left: float
    right: float
    to_right: bool

    def stays_left(self, values: np.ndarray) -> np.ndarray:
        near, far = np.abs(values - self.left), np.abs(values - self.right)
        return near < far if self.to_right else near <= far


@dataclass
class LineIndex:
    """The line's blocks in order: first value, count and units below, number of values. Cuts already looked up are kept."""

    line: DataFrame
    block: np.ndarray
    first: np.ndarray
    n_below: np.ndarray
    units_below: list[int]
    size: np.ndarray
    rows_read: int = 0
    known: dict[Cut, tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, line: DataFrame) -> LineIndex:
        """One pass over the line; at most ``MOST_BLOCKS`` rows and a last one for the totals come back."""
        blocks = line.groupBy("block").agg(
            F.min("value").alias("first"), F.min("n_below").alias("n"), F.min_by("units_below", "value").alias("units"), F.count(F.lit(1)).alias("size")
        )
        end = line.agg(F.max(F.struct("value", (F.col("n_below") + F.col("n")).alias("n"), (F.col("units_below") + F.col("units")).alias("units"))))
        rows, last = blocks.orderBy("first").collect(), end.first()[0]
        return cls(
            line,
            np.array([r["block"] for r in rows], dtype=np.int64),
            np.array([r["first"] for r in rows], dtype=float),
            np.array([r["n"] for r in rows] + [last["n"] if last else 0], dtype=np.int64),
            [int(r["units"]) for r in rows] + [int(last["units"]) if last else 0],
            np.array([r["size"] for r in rows], dtype=np.int64),
        )

    def blocks_left_of(self, cut: Cut) -> int:
        """Number of blocks whose first value stays left of the cut."""
        at = int(np.searchsorted(self.first, (cut.left + cut.right) / 2))
        while at > 0 and not cut.stays_left(self.first[at - 1]):
            at -= 1
        while at < len(self.first) and cut.stays_left(self.first[at]):
            at += 1
        return at

    def below(self, cuts: list[Cut]) -> list[tuple[int, int]]:
        """Count and units of the values left of each cut. Reads the blocks that a new cut goes through, at most one a cut."""
        inside: dict[Cut, int] = {}
        for cut in dict.fromkeys(cuts):
            if cut in self.known:
                continue
            at = self.blocks_left_of(cut)
            if at and self.size[at - 1] > 1:
                inside[cut] = at - 1
            else:
                self.known[cut] = (int(self.n_below[at]), self.units_below[at])
        if inside:
            self._read(inside)
        return [self.known[cut] for cut in cuts]

    def _read(self, inside: dict[Cut, int]) -> None:
        order = list(inside)
        rows = [(i, int(self.block[inside[c]]), c.left, c.right, c.to_right) for i, c in enumerate(order)]
        asked = self.line.sparkSession.createDataFrame(rows, "cut int, block long, l double, r double, to_right boolean")
        left, right = F.abs(F.col("value") - F.col("l")), F.abs(F.col("value") - F.col("r"))
        stays = F.when(F.col("to_right"), left < right).otherwise(left <= right)
        found = (
            self.rows_of({r[1] for r in rows})
            .join(F.broadcast(asked), "block")  # a row a cut
            .groupBy("cut")
            .agg(
                F.sum(F.when(stays, F.col("n"))).alias("n"),
                F.sum(F.when(stays, F.col("units"))).alias("units"),
                F.count(F.lit(1)).alias("rows"),
            )
            .collect()
        )
        for r in found:
            at = inside[order[r["cut"]]]
            self.known[order[r["cut"]]] = (int(self.n_below[at]) + r["n"], self.units_below[at] + int(r["units"]))
            self.rows_read += r["rows"]

    def rows_of(self, blocks: set[int]) -> DataFrame:
        """The rows of these blocks: neighbouring ones make ranges, which the file reader skips by.

        At most ``MOST_RANGES`` ranges, over the smallest gaps; the blocks in those gaps are left out by a look-up. A condition
        for each of hundreds of blocks would be too long to compile, anew in every round.
        """
        order = np.array(sorted(blocks), dtype=np.int64)
        gaps = np.diff(order)
        breaks = np.flatnonzero(gaps > 1)
        widest = breaks[np.argsort(-gaps[breaks], kind="stable")][: MOST_RANGES - 1]
        ranges = np.split(order, np.sort(widest) + 1)
        rows = self.line.filter(_balanced_or([F.col("block").between(int(r[0]), int(r[-1])) for r in ranges]))
        return rows if len(breaks) < MOST_RANGES else rows.filter(F.col("block").isin(order.tolist()))


def _clusters(index: LineIndex, centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, list[int]]]:
    """Count and units of every cluster, for every k."""
    orders, cuts = {}, []
    for k, at in centers.items():
        order = np.lexsort((np.arange(k), at))
        # Of equal centers only the first in index order can win.
        order = order[np.concatenate(([True], at[order][1:] != at[order][:-1]))]
        orders[k] = order
        cuts += [Cut(float(at[a]), float(at[b]), bool(b < a)) for a, b in zip(order[:-1], order[1:], strict=True)]
    below = iter(index.below(cuts))
    found = {}
    for k, order in orders.items():
        upto = [(0, 0), *[next(below) for _ in order[1:]], (int(index.n_below[-1]), index.units_below[-1])]
        n, units = np.zeros(k, dtype=np.int64), [0] * k
        for i, (low, high) in zip(order.tolist(), zip(upto[:-1], upto[1:], strict=True), strict=True):
            n[i], units[i] = high[0] - low[0], high[1] - low[1]
        found[k] = (n, units)
    return found


def _means(n: np.ndarray, units: list[int], otherwise: np.ndarray) -> np.ndarray:
    return np.array([float(u) / float(m) / UNIT if m else float(c) for m, u, c in zip(n.tolist(), units, otherwise, strict=True)])


def lloyd(line: DataFrame, starts: dict[int, np.ndarray], index: LineIndex | None = None) -> dict[int, np.ndarray]:
    """Move every k's centers to their clusters' means until no value changes cluster."""
    index = index or LineIndex.of(line)
    centers, done = dict(starts), {}
    before = _clusters(index, centers)
    for _ in range(MAX_ROUNDS):
        moved = {k: _means(n, units, centers[k]) for k, (n, units) in before.items()}
        after = _clusters(index, moved)
        for k in list(moved):
            # Clusters are intervals: the same counts along the same order of centers are the same sets.
            same_order = np.array_equal(np.argsort(moved[k], kind="stable"), np.argsort(centers[k], kind="stable"))
            centers[k] = moved[k]
            if same_order and np.array_equal(after[k][0], before[k][0]):
                done[k] = centers.pop(k)
                after.pop(k)
        before = after
        if not centers:
            break
    return {**done, **centers}


def silhouettes(values: DataFrame, centers: dict[int, np.ndarray], index: LineIndex | None = None) -> dict[int, float]:
    """Mean silhouette per k; -1 with fewer than two clusters or any cluster of one member.

    ``values`` rows carry ``n_below`` and ``sum_below`` over the whole line. One pass over them for all k.
    """
    scores = {k: NO_SCORE for k in centers}
    usable = {}
    for k, (n, units) in _clusters(index or LineIndex.of(values), centers).items():
        total = np.array(units, dtype=float) / UNIT
        filled = np.flatnonzero(n > 0)
        if len(filled) < 2 or (n[filled] < 2).any():
            continue
        means = total[filled] / n[filled]
        order = filled[np.argsort(means, kind="stable")]
        sizes, sums = n[order], total[order]
        start_n = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        start_sum = np.concatenate(([0.0], np.cumsum(sums)[:-1]))
        place = np.zeros(k, dtype=np.int64)
        place[order] = np.arange(len(order))
        usable[k] = (centers[k], place, sizes, sums, sums / sizes, start_n, start_sum)
    if not usable:
        return scores

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = {k: 0.0 for k in usable}
        for batch in batches:
            value, n, below, below_sum = (batch.column(i).to_numpy() for i in range(4))
            for k, (at, place, sizes, sums, means, start_n, start_sum) in usable.items():
                c = place[_assign(value, at)]
                inner_n, inner_sum = below - start_n[c], below_sum - start_sum[c]
                own = value * inner_n - inner_sum + (sums[c] - inner_sum) - value * (sizes[c] - inner_n)
                a = np.maximum(own, 0.0) / (sizes[c] - 1)
                padded = np.concatenate(([-np.inf], means, [np.inf]))
                b = np.minimum(value - padded[c], padded[c + 2] - value)
                score[k] += float(np.sum(n * (b - a) / np.maximum(np.maximum(a, b), SMALLEST_SCALE)))
        yield pa.RecordBatch.from_pydict(
            {"k": pa.array(list(score), pa.int32()), "score": pa.array(list(score.values()), pa.float64())}
        )

    members = sum(int(s) for s in next(iter(usable.values()))[2])
    rows = (
        values.select("value", "n", "n_below", "sum_below")
        .mapInArrow(partial, "k int, score double")
        .groupBy("k")
        .agg(F.sum("score").alias("score"))
        .collect()
    )
    return scores | {r.k: r.score / members for r in rows}


def value_line(values: DataFrame, value: str, blocks: int | None = None) -> DataFrame:
    """Distinct finite values of ``RANK_DIGITS`` places in order, with what lies below each, cut into at most ``blocks`` blocks.

    (value, n, units, n_below, units_below, sum_below, block): n rows have the value, units is their sum in whole
    1 / ``UNIT``, n_below and units_below count all smaller values, sum_below is the latter as a number.
    """
    kept = values.select(rank_key(F.col(value)).alias("value")).filter(F.abs("value") < float("inf"))
    counted = kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    units = F.round(F.col("value") * UNIT).cast("decimal(38,0)") * F.col("n").cast("decimal(20,0)")
    counted = counted.withColumn("units", units.cast("decimal(38,0)"))
    width = shuffle_width(counted)
    laid = materialise(
        counted.repartitionByRange(width, "value").withColumn("_piece", F.spark_partition_id())
    )
    inside = Window.partitionBy("_piece").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    pieces = laid.groupBy("_piece").agg(F.sum("n").alias("_n"), F.sum("units").alias("_units"), F.count(F.lit(1)).alias("_rows"))
    everything = Window.partitionBy(F.lit(0))
    earlier = everything.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("decimal(38,0)")
    offsets = pieces.select(
        "_piece",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_base"),
        F.coalesce(F.sum("_units").over(earlier), none).alias("_units_base"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_base"),
        F.ceil(F.sum("_rows").over(everything) / F.lit(blocks or MOST_BLOCKS)).alias("_size"),
    )
    line = laid.join(small(offsets, width), "_piece").select(
        "value",
        "n",
        "units",
        (F.col("_n_base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("n_below"),
        (F.col("_units_base") + F.coalesce(F.sum("units").over(inside), none)).cast("decimal(38,0)").alias("units_below"),
        F.expr("(_rows_base + row_number() OVER (PARTITION BY _piece ORDER BY value) - 1) div _size").alias("block"),
    )
    return materialise(line.withColumn("sum_below", F.col("units_below").cast("double") / UNIT))


def quantile_starts(line: DataFrame, n: int, ks: range, index: LineIndex | None = None) -> dict[int, np.ndarray]:
    """Start centers: for each k the order statistics at (i + 1/2)/k."""
    index = index or LineIndex.of(line)
    picks = {k: [min(n - 1, math.floor((i + 0.5) / k * n)) for i in range(k)] for k in ks}
    places = np.array(sorted({p for at in picks.values() for p in at}), dtype=np.int64)
    holder = np.searchsorted(index.n_below[:-1], places, side="right") - 1
    alone = index.size[holder] == 1
    by_place = dict(zip(places[alone].tolist(), index.first[holder[alone]].tolist(), strict=True))
    if not alone.all():
        asked = list(zip(index.block[holder[~alone]].tolist(), places[~alone].tolist(), strict=True))
        wanted = line.sparkSession.createDataFrame(asked, "block long, at long")
        hit = (F.col("at") >= F.col("n_below")) & (F.col("at") < F.col("n_below") + F.col("n"))
        rows = index.rows_of({b for b, _ in asked}).join(F.broadcast(wanted), "block").filter(hit)  # a row a place
        by_place |= {r["at"]: r["value"] for r in rows.select("value", "at").collect()}
    return {k: np.array([by_place[p] for p in at]) for k, at in picks.items()}


def choose_centers(index: LineIndex) -> np.ndarray:
    """Centers of the first k with the best silhouette."""
    n = int(index.n_below[-1])
    found = lloyd(index.line, quantile_starts(index.line, n, k_range(n), index), index)
    scores = silhouettes(index.line, found, index)
    best = max(sorted(found), key=lambda k: (round(scores[k], SCORE_DIGITS), -k))
    return found[best]


def tier_of(value: Column, centers: np.ndarray) -> Column:
    """Tier 1 is the highest center's; a value takes its nearest center's tier."""
    order = np.argsort(-centers, kind="stable")
    tiers = np.empty(len(centers), dtype=int)
    tiers[order] = np.arange(1, len(centers) + 1)
    at = nearest(value, F.array(*[F.lit(float(c)) for c in centers]))
    return F.element_at(F.array(*[F.lit(int(t)) for t in tiers]), at + 1)


def assign_tiers(ranked: DataFrame, value: str = "war", rank: str = "overall_rank") -> DataFrame:
    """Add ``tier``; rank-balanced tiers when clustering leaves fewer distinct tiers than the smallest k.

    A row without a finite value is in no cluster and takes the first center's tier.
    """
    index = LineIndex.of(value_line(ranked.select(value), value))
    n = int(index.n_below[-1])
    if n < FEWEST_VALUES:
        return ranked.withColumn("tier", F.lit(1))
    centers = choose_centers(index)
    # Of equal centers the first has all values; a cluster without values is no tier that is used.
    counts, _ = _clusters(index, {len(centers): centers})[len(centers)]
    low = k_range(n)[0]
    if int((counts > 0).sum()) < low:
        return ranked.withColumn("tier", balanced_tier(F.col(rank), ranked.count(), low))
    return ranked.withColumn("tier", tier_of(rank_key(F.col(value)), centers))


def rank_balanced(valued: DataFrame, tiers: int, order: list[Column]) -> DataFrame:
    """Rank-balanced tiers for rows that carry no rank yet."""
    ranked = number_rows(valued, order, "overall_rank")
    total = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranked.withColumn("tier", balanced_tier(F.col("overall_rank"), total, tiers))

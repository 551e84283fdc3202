"""Fantasy points from raw stats under a set of scoring weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waterline.config import ScoringWeights
from waterline.schema import STATS, Fields, stat_headers


def fantasy_points(row: Fields, pos: Column, weights: ScoringWeights) -> Column:
    """Weighted sum of the stats; NULL when no stat column of the row holds a value."""
    total = None
    for stat in STATS:
        weight = F.lit(float(getattr(weights, stat)))
        if stat == "rec" and weights.te_premium:
            weight = weight + F.when(pos == "TE", float(weights.te_premium)).otherwise(0.0)
        if not row.has(stat):
            continue
        term = row.number(stat, 0.0) * weight
        total = term if total is None else total + term
    if total is None:
        return F.lit(None).cast("double")
    return F.when(row.any_present(stat_headers()), total)

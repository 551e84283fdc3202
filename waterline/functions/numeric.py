"""Number parsing and the normal-distribution arithmetic behind wins above replacement.

The formulas are Spark SQL text over column names (or other SQL fragments): one parsed expression
each, evaluated in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal text accepted as a number, once thousands commas are dropped.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Rational approximation 7.1.26 of the error function (Abramowitz and Stegun).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
# Arguments below this are float noise around zero.
ERF_ZERO = 1e-10

# Values this close are one rank tie; keeps ranks independent of the order of float sums.
RANK_DIGITS = 9


def finite(col: Column) -> Column:
    """The double itself, or NULL for NaN and the infinities."""
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def to_number(col: Column) -> Column:
    """Text to a finite double; blank, dash or malformed text gives NULL."""
    text = F.replace(col, F.lit(","), F.lit(""))
    return F.when(text.rlike(DECIMAL_TEXT), finite(text.try_cast("double")))


def erf_scale_sql(x: str) -> str:
    """The variable the error function's polynomial is written in."""
    return f"(1D / (1D + {ERF_P}D * abs({x})))"


def erf_sql(x: str, t: str | None = None) -> str:
    """Error function. The approximation jumps by 2e-9 at zero, so a mere rounding error counts as zero.

    ``t`` names a column that already holds ``erf_scale_sql`` of ``x``.
    """
    t = t or erf_scale_sql(x)
    poly = f"{ERF_A[-1]}D"
    for a in reversed(ERF_A[:-1]):
        poly = f"({poly} * {t} + {a}D)"
    curve = f"signum({x}) * (1D - {poly} * {t} * exp(-({x}) * ({x})))"
    return f"(CASE WHEN abs({x}) < {ERF_ZERO}D THEN 0D ELSE {curve} END)"


def normal_cdf_sql(x: str, mean: str, std: str) -> str:
    """Normal CDF; a spread that is missing, infinite or not positive gives a step at the mean."""
    bell = win_share_sql(x, mean, std)
    step = f"CASE WHEN {x} >= {mean} THEN 1D ELSE 0D END"
    return f"CASE WHEN {std} > 0 AND {std} < double('Infinity') THEN {bell} ELSE {step} END"


def win_share_sql(score: str, pool_avg: str, team_std: str) -> str:
    """Chance that an average team wins when ``score`` replaces its average starter of the pool.

    This is the normal CDF of team average - pool average + score around the team average, so the
    team average cancels. The team spread is at least 1.
    """
    return f"(0.5D * (1D + {erf_sql(standing_sql(score, pool_avg, team_std))}))"


def standing_sql(score: str, pool_avg: str, team_std: str) -> str:
    return f"(({score} - {pool_avg}) / ({team_std} * sqrt(2D)))"


def wins_above_sql(score: str, pool_avg: str, replacement: str, team_std: str) -> str:
    """Single-period wins above replacement of ``score`` in a pool."""
    return f"({win_share_sql(score, pool_avg, team_std)} - {win_share_sql(replacement, pool_avg, team_std)})"


def mean_or_zero_sql(value: str) -> str:
    """Aggregate mean of the finite values, 0 when there are none."""
    return f"coalesce(avg({_finite_sql(value)}), 0D)"


def spread_sql(value: str) -> str:
    """Population standard deviation; at most one value gives max(mean/5, 1)."""
    clean = _finite_sql(value)
    few = f"greatest({mean_or_zero_sql(value)} * 0.2D, 1D)"
    return f"CASE WHEN count({clean}) <= 1 THEN {few} ELSE stddev_pop({clean}) END"


def _finite_sql(value: str) -> str:
    return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} END"


def erf(x: str) -> Column:
    return F.expr(erf_sql(x))


def normal_cdf(x: str, mean: str, std: str) -> Column:
    return F.expr(normal_cdf_sql(x, mean, std))


def wins_above(score: str, pool_avg: str, replacement: str, team_std: str) -> Column:
    return F.expr(wins_above_sql(score, pool_avg, replacement, team_std))


def mean_or_zero(value: str) -> Column:
    return F.expr(mean_or_zero_sql(value))


def spread(value: str) -> Column:
    return F.expr(spread_sql(value))


def per_game(points: Column, weeks: int) -> Column:
    return F.try_divide(points, F.lit(float(weeks)))


def whole_rank(rank: str) -> Column:
    """Rank rounded half up, at least 1; a missing rank counts as 1."""
    return F.expr(f"greatest(1, int(floor(coalesce({rank}, 1D) + 0.5D)))")


def rank_key(value: Column) -> Column:
    return F.round(value, RANK_DIGITS)


def nearest(value: Column, centers: Column) -> Column:
    """Index (from 0) of the closest center, the lowest index on ties."""
    gaps = F.transform(centers, lambda c, i: F.struct(F.abs(value - c).alias("gap"), i.alias("at")))
    return F.array_min(gaps)["at"]

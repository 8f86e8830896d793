"""Arithmetic expressions with the NULL and rounding rules the fare jobs rely on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def whole(value: Column, scale: int = 0) -> Column:
    """Round half away from zero to ``scale`` decimals, kept as a double.

    Whole currency units are exact in a double up to 2**53, and so are their sums, which
    keeps totals independent of the order in which tasks finish.
    """
    if scale:
        return value.cast(f"decimal(18,{scale})").cast("double")
    # The part after the point is exact in binary, so this needs no decimal type.
    size = F.abs(value.cast("double"))
    below = F.floor(size)
    up = F.when(size - below >= 0.5, below + 1).otherwise(below)
    return F.signum(value.cast("double")) * up


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL, not an error, for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def rounded(value: Column, digits: int = 2) -> Column:
    """Decimal rounding half up, so 1.005 gives 1.01 whatever its binary form."""
    return value.cast("decimal(38,10)").cast(f"decimal(38,{digits})").cast("double")


def percent(part: Column, total: Column) -> Column:
    return ratio(F.lit(100.0) * part.cast("double"), total)


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` kept within bounds; NULL stays NULL (``least``/``greatest`` skip NULLs)."""
    bounded = F.least(F.lit(high), F.greatest(F.lit(low), value))
    return F.when(value.isNotNull(), bounded)


def safe_add(*terms: Column) -> Column:
    """Sum that counts NULL as 0."""
    total = F.coalesce(terms[0], F.lit(0))
    for term in terms[1:]:
        total = total + F.coalesce(term, F.lit(0))
    return total


def width_bucket(value: Column, low, high, buckets: int) -> Column:
    """Equal-width bucket: 0 below ``low``, ``buckets + 1`` at or above ``high``."""
    return F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), buckets)


def z_score(value: Column, p50: Column, p95: Column) -> Column:
    """Robust z-score; sigma is taken from the normal distance of p95 and p50."""
    return ratio(value - p50, (p95 - p50) / F.lit(1.645))

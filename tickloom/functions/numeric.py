"""Number helpers that stay inside built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for any price or percentage, fine enough for six-place output.
_ROUNDING_TYPE = "decimal(38,12)"


def round_half_up(value: Column, places: int) -> Column:
    """Round on decimals and return a double; what does not fit becomes null."""
    return F.round(value.try_cast(_ROUNDING_TYPE), places).cast("double")


def safe_pct(numerator: Column, denominator: Column) -> Column:
    """Percentage that is null, not an error, on a null or zero denominator."""
    return F.try_divide(numerator, denominator) * F.lit(100.0)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def at_most(value: Column, ceiling: float) -> Column:
    """Cap at ``ceiling``; ``least`` skips nulls, so nulls count as zero first."""
    return F.least(zero_if_null(value), F.lit(float(ceiling)))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), at_most(value, high))

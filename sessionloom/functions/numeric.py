"""Numeric column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round a non-negative double half-up on its binary value, same in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(as_col(value).cast("double") * scale + F.lit(0.5)).cast("double") / scale


def clip(value: Column | str, low: float | int, high: float | int | None = None) -> Column:
    """Limit a value to ``[low, high]`` (no upper limit when ``high`` is None); null stays null."""
    col = as_col(value)
    kept = F.greatest(col, F.lit(low))
    if high is not None:
        kept = F.least(kept, F.lit(high))
    return F.when(col.isNotNull(), kept)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where the denominator is 0 or either side is null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def scaled_share(value: Column | str, maximum: float) -> Column:
    """``value / maximum`` capped at 1, for radar-style profiles."""
    return F.least(as_col(value).cast("double") / F.lit(float(maximum)), F.lit(1.0))


def at_least(value: Column | str, threshold: float) -> Column:
    """0/1 decision ``value >= threshold``."""
    return flag(as_col(value) >= F.lit(float(threshold)))


def interval_index(value: Column, splits: list[float]) -> Column:
    """Number of ascending ``splits`` that are <= value (0 for null)."""
    if not splits:
        return F.lit(0)
    return reduce(lambda acc, s: acc + flag(value >= F.lit(float(s))), splits, F.lit(0))

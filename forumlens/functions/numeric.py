"""Rounding and clamping that agree with half-even array arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled value; Spark's own round and bround differ on x.xx5."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit a value to [low, high]; unlike least/greatest a null stays null."""
    return F.when(value < low, F.lit(float(low))).when(value > high, F.lit(float(high))).otherwise(value)


def no_nan(value: Column) -> Column:
    """NaN compares above every number in Spark; as null it fails every threshold instead."""
    return F.when(~F.isnan(value), value)


def number_or_zero(value: Column) -> Column:
    """Safe numeric parse: unparsable, missing and NaN all become 0."""
    parsed = value.try_cast("double")
    return F.coalesce(no_nan(parsed), F.lit(0.0))

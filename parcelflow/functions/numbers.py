"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.config import Limits


def capacity_number(weight: Column, volume: Column, limits: Limits) -> Column:
    """How many capacities a running total has begun to use, by the scarcer of the two."""
    return F.greatest(
        F.ceil(F.try_divide(volume, F.lit(limits.volume))),
        F.ceil(F.try_divide(weight, F.lit(limits.weight))),
    )


def clamped(value: Column, cap: float) -> Column:
    return F.when(value > F.lit(cap), F.lit(cap)).otherwise(value)


def millionths(value: Column) -> Column:
    """Whole number of millionths, so that sums are exact."""
    return F.round(value * 1e6).cast("bigint")


def whole_load(value: Column) -> Column:
    return F.ceil(value).cast("int")


def rounded_lat(value: Column) -> Column:
    return F.round(value, 6)


def rounded_lon(value: Column) -> Column:
    return F.round(value, 7)

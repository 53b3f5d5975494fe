"""Groups of orders that travel together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.numbers import capacity_number, clamped
from parcelflow.operators.slices import GROUP_LIMIT, running_totals

FIFO = ("order_timestamp", "order_id")


def capacity_batches(
    orders: DataFrame,
    period: str = "hour",
    limits: config.Limits = config.PACK_LIMITS,
    order: Sequence[str] = FIFO,
    group_limit: int = GROUP_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Number the orders of a period, first in first out, by the capacities their running totals fill.

    An order belongs to the batch its running total reaches, so a batch may exceed the capacity by
    part of its first order, and one large order may skip a number.
    """
    rows = orders.drop("batch_id")
    summed = running_totals(
        rows, [period], order, {"_weight": "total_weight", "_volume": "total_volume"}, group_limit, slices
    )
    number = capacity_number(F.col("_weight").cast("double"), F.col("_volume").cast("double"), limits)
    return summed.select(
        *[F.lit(config.READY_FOR_DISPATCH).alias(name) if name == "status" else F.col(name) for name in rows.columns],
        number.alias("batch_id"),
    )


def batch_totals(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batches.groupBy(*keys, "batch_id").agg(
        F.count("*").alias("orders"),
        F.sum("total_weight").alias("total_weight"),
        F.sum("total_volume").alias("total_volume"),
        F.min("order_timestamp").alias("first_order"),
        F.max("order_timestamp").alias("last_order"),
    )


def tumbling_totals(orders: DataFrame, length: str = "2 minutes", at: str = "order_timestamp") -> DataFrame:
    """Weight and volume per time window; on a stream set a watermark first."""
    return orders.groupBy(F.window(at, length)).agg(
        F.sum("total_weight").alias("total_weight"), F.sum("total_volume").alias("total_volume")
    )


def dispatchable_windows(
    orders: DataFrame,
    length: str = "1 minute",
    floor: config.Limits = config.WINDOW_FLOOR,
    lorry: config.Limits = config.LORRY_LIMITS,
    at: str = "order_timestamp",
) -> DataFrame:
    """Windows above both floors, with what one lorry can take of them."""
    summed = orders.groupBy(F.window(at, length)).agg(
        F.sum("total_volume").alias("accumulated_volume"),
        F.sum("total_weight").alias("accumulated_weight"),
        F.count("*").alias("orders"),
    )
    volume, weight = F.col("accumulated_volume"), F.col("accumulated_weight")
    return summed.filter((volume > floor.volume) & (weight > floor.weight)).withColumns(
        {
            "ready_volume": clamped(volume, lorry.volume),
            "ready_weight": clamped(weight, lorry.weight),
            "status": F.lit(config.READY_FOR_DISPATCH),
        }
    )


def window_members(orders: DataFrame, length: str = "10 minutes", at: str = "order_timestamp") -> DataFrame:
    """Orders with the start of their window and the window's true totals.

    Members stay rows, however many a window has; only the totals, one row per window, are joined to them.
    """
    rows = orders.withColumn("window_start", F.window(at, length)["start"])
    totals = rows.groupBy("window_start").agg(
        F.sum("total_volume").alias("accumulated_volume"),
        F.sum("total_weight").alias("accumulated_weight"),
        F.count("*").alias("window_orders"),
    )
    return rows.join(totals, "window_start", "left").select(
        *orders.columns, "window_start", "accumulated_volume", "accumulated_weight", "window_orders"
    )


def dispatchable_members(
    orders: DataFrame,
    length: str = "1 minute",
    floor: config.Limits = config.WINDOW_FLOOR,
    lorry: config.Limits = config.LORRY_LIMITS,
    at: str = "order_timestamp",
) -> DataFrame:
    """Orders of the windows above both floors, with what one lorry can take of their window."""
    windows = dispatchable_windows(orders, length, floor, lorry, at)
    kept = windows.select(F.col("window.start").alias("window_start"), "ready_volume", "ready_weight", "status")
    rows = orders.drop("status").withColumn("window_start", F.window(at, length)["start"])
    return rows.join(kept, "window_start")

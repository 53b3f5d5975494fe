"""Order cleaning: event to silver to gold to ready. Every step works on batches and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions import geo, times
from parcelflow.operators.flatten import flatten_structs


def silver_orders(events: DataFrame, depots: Sequence[config.Depot] = config.DEPOTS) -> DataFrame:
    """Flat order with its coordinates, nearest depot and parsed order time."""
    flat = flatten_structs(events)
    lat = F.col("order_details_destination_address_lat")
    lon = F.col("order_details_destination_address_lon")
    return flat.withColumns(
        {
            "lat": lat,
            "lon": lon,
            "depot": geo.nearest_depot(lat, lon, depots),
            "order_timestamp": times.parsed(F.col("order_details_order_timestamp")),
        }
    )


def gold_orders(silver: DataFrame) -> DataFrame:
    """Paid orders in the short layout, with the hour they are stored under."""
    return silver.filter(F.col("order_details_payment_details_payment_status") == config.PAID).select(
        "order_id",
        F.col("order_details_customer_id").alias("customer_id"),
        F.col("order_details_total_weight").alias("total_weight"),
        F.col("order_details_total_volume").alias("total_volume"),
        F.col("order_details_total_amount").alias("total_price"),
        "order_timestamp",
        F.col("order_details_status").alias("status"),
        "lat",
        "lon",
        "depot",
        times.hour_start(F.col("order_timestamp")).alias("hour"),
    )


def ready_orders(gold: DataFrame, status: str = config.READY) -> DataFrame:
    """Copy for the packing job: time as a timestamp, status set."""
    return with_status(gold, status).withColumn("order_timestamp", F.col("order_timestamp").try_cast("timestamp"))


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.withColumn("status", F.lit(status))


def promoted(status: Column, old: str = config.RECEIVED, new: str = config.READY_FOR_DELIVERY) -> Column:
    """``new`` where the status is ``old``, else the status as it is."""
    return F.when(status == old, F.lit(new)).otherwise(status)


def having_status(df: DataFrame, *statuses: str) -> DataFrame:
    status = F.col("status")
    return df.filter(status == statuses[0] if len(statuses) == 1 else status.isin(*statuses))


def by_hour_label(df: DataFrame) -> DataFrame:
    """Received orders promoted, stored under a text hour."""
    return df.withColumns(
        {"order_hour": times.hour_label(F.col("order_timestamp")), "status": promoted(F.col("status"))}
    )

"""Reports over loaded route solutions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.operators.solutions import driver_stops, run_summary


def stops_with_totals(solutions: DataFrame) -> DataFrame:
    """Stops next to the totals of their run and driver.

    Both come from the same row of the run, so the totals ride along and no join is needed.
    """
    output = F.col("output")
    stops = driver_stops(
        solutions,
        output["status"].alias("status"),
        output["total_distance"].alias("total_distance"),
        output["total_travel_time"].alias("total_travel_time"),
        output["distances"].alias("_distances"),
    )
    return stops.select(
        "id",
        "finished_at",
        "dispatched_date",
        "driver_id",
        "arrival_time",
        F.col("distance").alias("segment_distance"),
        "finish_time",
        "location_id",
        "location_name",
        "status",
        "total_distance",
        "total_travel_time",
        F.try_element_at("_distances", F.col("driver_id")).alias("total_driver_distance"),
    )


def join_stops_to_runs(
    stops: DataFrame, summary: DataFrame, drivers: Sequence[str], keys: Sequence[str] = ("id", "finished_at")
) -> DataFrame:
    """The same from separately stored stops and run summaries.

    Joined by run and finish time; ``keys=("finished_at",)`` pairs all runs that share a finish time.
    """
    own = F.create_map(*[part for d in drivers for part in (F.lit(d), F.col(f"distance_{d}"))])
    runs = summary.select(
        *keys, "status", "total_distance", "total_travel_time", own.alias("_distances")
    )
    return stops.join(runs, list(keys)).select(
        "finished_at",
        "dispatched_date",
        "driver_id",
        "arrival_time",
        F.col("distance").alias("segment_distance"),
        "finish_time",
        "location_id",
        "location_name",
        "status",
        "total_distance",
        "total_travel_time",
        F.try_element_at("_distances", F.col("driver_id")).alias("total_driver_distance"),
    )


def driver_totals(stops: DataFrame) -> DataFrame:
    return stops.groupBy("driver_id").agg(
        F.sum("distance").alias("total_route_distance"), F.count("*").alias("num_stops")
    )


def driver_performance(solutions: DataFrame, drivers: Sequence[str] = tuple(config.driver_ids())) -> DataFrame:
    """Distance and overtime per run for every driver of the fleet, driving or not."""
    fleet = F.array(*[F.lit(d) for d in drivers])
    rows = solutions.select(
        "id",
        "dispatched_date",
        "finished_at",
        F.col("output.distances").alias("distances"),
        F.col("output.vehicle_overtime").alias("overtime"),
        F.explode(fleet).alias("driver_id"),
    )
    return rows.select(
        "id",
        "driver_id",
        "dispatched_date",
        "finished_at",
        F.try_element_at("distances", F.col("driver_id")).alias("total_distance"),
        F.try_element_at("overtime", F.col("driver_id")).alias("total_overtime"),
    )


def unserved_runs(solutions: DataFrame) -> DataFrame:
    rows = run_summary(solutions, ()).select("id", "dispatched_date", "finished_at", "unserved")
    return rows.filter(F.col("unserved").isNotNull() & (F.col("unserved") != ""))


def late_runs(solutions: DataFrame) -> DataFrame:
    rows = run_summary(solutions, ())
    return rows.filter(F.col("num_late_visits") > 0).select(
        "id", "dispatched_date", "finished_at", "num_late_visits", "total_visit_lateness"
    )


STOP_ORDER = ("finished_at", "arrival_time", "id", "location_id")


def sorted_stops(stops: DataFrame) -> DataFrame:
    """All stops by driver and time; the trailing keys make the order complete."""
    return stops.orderBy("driver_id", *STOP_ORDER)


def sorted_performance(performance: DataFrame) -> DataFrame:
    return performance.orderBy("driver_id", "dispatched_date", "finished_at", "id")


def sorted_totals(totals: DataFrame) -> DataFrame:
    return totals.orderBy("driver_id")


def top_stops_of(stops: DataFrame, driver_id: str, count: int = 20) -> DataFrame:
    return stops.filter(F.col("driver_id") == driver_id).orderBy(*STOP_ORDER).limit(count)


def top_stops_per_driver(stops: DataFrame, count: int = 20) -> DataFrame:
    """First stops of every driver in one job; each task passes on at most ``count`` rows per driver."""
    by_driver = Window.partitionBy("driver_id").orderBy(*STOP_ORDER)
    ranked = stops.withColumn("rank", F.row_number().over(by_driver))
    return ranked.filter(F.col("rank") <= count)


SHOWN_STATUSES = (config.DISPATCHED, config.READY_FOR_DISPATCH)


def dispatch_status(orders: DataFrame, limit: int | None = None) -> DataFrame:
    """Orders on the way or waiting for it, all or the first few."""
    rows = orders.filter(F.col("status").isin(*SHOWN_STATUSES))
    return rows if limit is None else rows.orderBy("order_timestamp", "order_id").limit(limit)

"""Route solutions: loading, stops, totals, served customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions import times
from parcelflow.operators.flatten import drop_fields, unnest
from parcelflow.operators.orders import with_status
from parcelflow.sources.sinks import updated

# Fields of the answer that only drawing a map needs.
DRAWING_FIELDS = ("pl_precision", "polylines")


def with_dispatch_times(solutions: DataFrame) -> DataFrame:
    """Half hour and day a run was finished in; the half hour is a partition of the loaded table."""
    done = F.col("timing.finishedProcessingAt")
    return solutions.withColumns(
        {
            "dispatched_hour": times.half_hour_label(done, config.UNKNOWN_HOUR),
            "dispatched_date": times.day(times.parsed_iso(F.col("finished_at"))),
        }
    )


def next_day_partition(solutions: DataFrame) -> DataFrame:
    """Older layout: stored under the day after the run."""
    return solutions.withColumn("dispatched_date", times.next_day(times.parsed_iso(F.col("finished_at"))))


def same_day_partition(solutions: DataFrame) -> DataFrame:
    """Older layout: chosen columns, a time usable in file names, stored under the day of the run."""
    at = times.parsed_iso(F.col("finished_at"))
    return solutions.select(
        "id",
        "status",
        "finished_at",
        "input",
        "region",
        "output",
        times.file_label(at).alias("finished_at_clean"),
        times.day(at).alias("dispatched_date"),
    )


def report_rows(solutions: DataFrame) -> DataFrame:
    """Answer fields as ``output_`` columns, without the drawing fields."""
    return unnest(solutions, "output", DRAWING_FIELDS, ["dispatched_hour", "dispatched_date", "finished_at"])


def trimmed_output(solutions: DataFrame) -> DataFrame:
    """Answer kept as a struct, without the drawing fields."""
    return drop_fields(solutions, "output", *DRAWING_FIELDS).select("output", "dispatched_date", "finished_at")


def route_archive(solutions: DataFrame) -> DataFrame:
    return solutions.select("input", "output", "dispatched_hour")


def route_lines(solutions: DataFrame) -> DataFrame:
    return solutions.select("id", "finished_at_clean", F.col("output.polylines").alias("polylines"))


def driver_stops(solutions: DataFrame, *extra: Column | str) -> DataFrame:
    """One row per stop, whoever drives: one scan, no union. Idle drivers have no rows."""
    routes = solutions.select(
        "id", "dispatched_date", "finished_at", *extra, F.explode("output.solution").alias("driver_id", "route")
    )
    kept = [name for name in routes.columns if name != "route"]
    stops = routes.select(*kept, F.explode("route").alias("stop"))
    return stops.select(
        *kept,
        "stop.arrival_time",
        "stop.distance",
        "stop.finish_time",
        "stop.location_id",
        "stop.location_name",
    )


def run_summary(solutions: DataFrame, drivers: Sequence[str] = tuple(config.driver_ids())) -> DataFrame:
    """One flat row per run; drivers that took no part have NULL."""
    totals = (
        "status",
        "total_break_time",
        "total_distance",
        "total_idle_time",
        "total_travel_time",
        "total_vehicle_overtime",
        "total_visit_lateness",
        "total_working_time",
        "num_late_visits",
        "num_unserved",
        "unserved",
    )
    output = F.col("output")
    return solutions.select(
        "id",
        "dispatched_date",
        "finished_at",
        *[output[name].alias(name) for name in totals],
        *[F.try_element_at(output["distances"], F.lit(d)).alias(f"distance_{d}") for d in drivers],
        *[F.try_element_at(output["vehicle_overtime"], F.lit(d)).alias(f"overtime_{d}") for d in drivers],
    )


def with_order_ids(solutions: DataFrame) -> DataFrame:
    """Stops at customers name their order as ``order_id``; depot stops keep ``location_id``.

    All stops share one type, so the name that does not apply is NULL. Drawing fields go.
    """

    def renamed(stop: Column) -> Column:
        place = stop["location_id"]
        at_depot = place.startswith(config.DEPOT_PREFIX)
        return F.struct(
            F.when(at_depot, place).alias("location_id"),
            F.when(~at_depot, place).alias("order_id"),
            *[stop[name].alias(name) for name in ("location_name", "arrival_time", "finish_time", "distance")],
        )

    routes = F.transform_values("output.solution", lambda _, route: F.transform(route, renamed))
    return drop_fields(solutions, "output", *DRAWING_FIELDS).withColumn(
        "output", F.col("output").withField("solution", routes)
    )


def served_customers(solutions: DataFrame, as_of: Column) -> DataFrame:
    """Customers with the time they are served on the day after ``as_of``; NULL time where it does not parse."""
    stops = driver_stops(solutions)
    return stops.filter(F.col("location_name").startswith(config.CUSTOMER_PREFIX)).select(
        F.col("location_name").alias("customer_id"),
        "finish_time",
        times.clock_on_next_day(as_of, F.col("finish_time")).alias("new_finish_time"),
    )


def latest_service(served: DataFrame) -> DataFrame:
    """One row per customer: a customer served twice counts with the later time."""
    return served.groupBy("customer_id").agg(F.max("new_finish_time").alias("new_finish_time"))


def mark_dispatched(orders: DataFrame, served: DataFrame) -> DataFrame:
    """All orders; those of served customers are ``DISPATCHED`` at the latest time of the customer."""
    return updated(
        orders,
        latest_service(served),
        ["customer_id"],
        {"status": F.lit(config.DISPATCHED), "order_timestamp": F.col("new_finish_time")},
    )


def dispatched_orders(orders: DataFrame, served: DataFrame) -> DataFrame:
    """Only the orders of served customers, marked."""
    latest = latest_service(served).withColumnRenamed("customer_id", "served_customer_id")
    joined = orders.join(latest, F.col("customer_id") == F.col("served_customer_id"))
    return with_status(joined, config.DISPATCHED).withColumn("order_timestamp", F.col("new_finish_time"))

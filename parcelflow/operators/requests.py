"""Routing requests: fleet, visits and one document per batch."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions.numbers import rounded_lat, rounded_lon, whole_load

_PLACE = "struct<id: string, name: string, lat: double, lng: double>"
_FLEET = f"""map<string, struct<
  start_location: {_PLACE}, end_location: {_PLACE}, shift_start: string, shift_end: string,
  min_visits: int, capacity: struct<weight: double, volume: double>>>"""


def driver_depot(
    number: int, fleet: config.Fleet, depots: Sequence[config.Depot], last_depot: bool = False
) -> config.Depot | None:
    """Where a driver starts; None if the depots have no room for another driver."""
    depot = (number - 1) // fleet.drivers_per_depot
    if depot >= len(depots):
        return None
    return depots[-1] if last_depot else depots[depot]


def fleet_plan(settings: config.Settings = config.Settings(), last_depot: bool = False) -> dict[str, dict]:
    """Driver settings by driver id.

    Each depot gets its share of the drivers in turn; ``last_depot`` starts all of them from the last one.
    """
    fleet = settings.fleet
    plan = {}
    for number in range(1, fleet.drivers + 1):
        depot = driver_depot(number, fleet, settings.depots, last_depot)
        if depot is not None:
            plan[f"driver_{number}"] = {
                "start_location": asdict(depot),
                "end_location": asdict(depot),
                "shift_start": fleet.shift_start,
                "shift_end": fleet.shift_end,
                "min_visits": fleet.min_visits,
                "capacity": {"weight": fleet.weight, "volume": fleet.volume},
                **settings.driver_rules,
            }
    return plan


def fleet_column(settings: config.Settings = config.Settings(), last_depot: bool = False) -> Column:
    """The fleet as a constant map: settings need no join."""
    return F.from_json(F.lit(json.dumps(fleet_plan(settings, last_depot))), _FLEET)


def fleet_table(
    spark: SparkSession, settings: config.Settings = config.Settings(), last_depot: bool = False
) -> DataFrame:
    """The fleet as rows: driver, depot, shift, capacity."""
    one = spark.range(1).select(F.explode(fleet_column(settings, last_depot)).alias("driver_id", "driver"))
    return one.select(
        "driver_id",
        F.col("driver.start_location.id").alias("depot_id"),
        F.col("driver.start_location.name").alias("depot"),
        "driver.shift_start",
        "driver.shift_end",
        "driver.min_visits",
        F.col("driver.capacity.weight").alias("capacity_weight"),
        F.col("driver.capacity.volume").alias("capacity_volume"),
    )


def depot_fleet(orders: DataFrame, fleet: DataFrame) -> DataFrame:
    """Fleet rows with the orders waiting at the driver's depot; drivers without orders stay."""
    waiting = orders.groupBy("depot").agg(
        F.count("*").alias("depot_orders"),
        F.sum("total_weight").alias("depot_weight"),
        F.sum("total_volume").alias("depot_volume"),
    )
    return fleet.join(waiting, "depot", "left")


def visit_column(visit: config.Visit = config.Visit()) -> Column:
    """A visit at the customer within the general time window."""
    return F.struct(
        F.struct(F.col("customer_id").alias("name"), F.col("lat").alias("lat"), F.col("lon").alias("lng")).alias(
            "location"
        ),
        F.lit(visit.start).alias("start"),
        F.lit(visit.end).alias("end"),
        F.lit(visit.duration).alias("duration"),
    )


def priority(order_id: Column, priorities: Sequence[str] = config.PRIORITIES) -> Column:
    """Repeatable stand-in for a priority that orders do not carry."""
    names = F.array(*[F.lit(name) for name in priorities])
    digits = F.conv(F.substring(F.md5(order_id), 1, 4), 16, 10).cast("int")
    return names[F.pmod(digits, F.lit(len(priorities)))]


def loaded_visit_column(
    visit: config.Visit = config.Visit(start="9:00"),
    name: Column | None = None,
    weight: Column | None = None,
    volume: Column | None = None,
    start: Column | None = None,
    end: Column | None = None,
    duration: Column | None = None,
) -> Column:
    """A visit with rounded coordinates, its load in whole units and a priority.

    Orders that lack an address, a load or a time window of their own get the usual ones.
    """

    def own_or(own: Column | None, usual: str | int) -> Column:
        return F.lit(usual) if own is None else F.coalesce(own, F.lit(usual))

    name = F.col("customer_id") if name is None else name
    weight = F.col("total_weight") if weight is None else weight
    volume = F.col("total_volume") if volume is None else volume
    return F.struct(
        F.struct(
            F.coalesce(name, F.lit("Unknown")).alias("name"),
            rounded_lat(F.col("lat")).alias("lat"),
            rounded_lon(F.col("lon")).alias("lng"),
        ).alias("location"),
        own_or(start, visit.start).alias("start"),
        own_or(end, visit.end).alias("end"),
        own_or(duration, visit.duration).alias("duration"),
        F.struct(
            whole_load(F.coalesce(weight, F.lit(10.0))).alias("weight"),
            whole_load(F.coalesce(volume, F.lit(200.0))).alias("volume"),
        ).alias("load"),
        priority(F.col("order_id")).alias("priority"),
    )


def visit_key() -> Column:
    """The order's id; an order without one is told apart by its customer and time, so it stays in the request."""
    unnamed = F.concat_ws("-", F.lit("no-id"), "customer_id", F.date_format("order_timestamp", "yyyyMMddHHmmss"))
    return F.coalesce(F.col("order_id"), unnamed)


def batch_visits(batches: DataFrame, keys: Sequence[str] = ("hour", "batch_id"), visit: Column | None = None) -> DataFrame:
    """Visits per batch as a map from order to visit, one row per batch.

    An order that occurs twice is visited once, as its last row by time says. A batch is bounded by the packing
    limits, so its visits fit into one row.
    """
    wanted = visit_column() if visit is None else visit
    entry = F.struct(visit_key().alias("id"), F.col("order_timestamp").alias("at"), wanted.alias("visit"))
    entries = batches.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("items"))
    # Equal ids are neighbours after sorting, in order of time; the last one counts.
    items = F.col("items")
    last_of_id = F.filter(
        items,
        lambda item, index: (index == F.size(items) - 1) | (F.try_element_at(items, index + F.lit(2))["id"] != item["id"]),
    )
    pairs = F.transform(last_of_id, lambda item: F.struct(item["id"].alias("key"), item["visit"].alias("value")))
    return entries.select(*keys, F.map_from_entries(pairs).alias("visits"))


def request_documents(
    batches: DataFrame,
    keys: Sequence[str] = ("hour", "batch_id"),
    settings: config.Settings = config.Settings(),
    visit: Column | None = None,
    last_depot: bool = False,
) -> DataFrame:
    """One JSON request per batch, built where the batch lies; nothing passes through the driver."""
    wanted = visit_column(settings.visit) if visit is None else visit
    visits = batch_visits(batches, keys, wanted)
    # Fleet and options are the same in every request, so their text is a constant.
    fleet = json.dumps(fleet_plan(settings, last_depot), ensure_ascii=False)
    same = f',"fleet":{fleet},"options":{json.dumps(settings.options)}}}'
    document = F.concat(F.lit('{"visits":'), F.to_json("visits"), F.lit(same))
    return visits.select(*keys, F.size("visits").alias("visits"), document.alias("document"))

"""The given tables seen as order events, flat orders, clients and route solutions.

All numbers that get summed are whole, all keys are computed, nothing is random, so any SQL engine
gives the same values. Documents stay small however large the tables are: an event holds at most
three items with two packages each, a run covers 512 order keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config
from parcelflow.functions import times
from parcelflow.operators.orders import gold_orders, silver_orders
from parcelflow.sources.tables import read_table

RUN_SIZE = 512
BUSY_DRIVERS = 17  # the last driver of the fleet stays idle
RUN_SPACING = 397  # seconds from one run to the next
RUN_SPAN = 630_720_000  # seconds after which run times start over
FIRST_RUN = "2024-10-01 00:00:00"
LATE_MINUTE = 1050
RETURN_FLAGS = ("A", "N", "R")
LINE_STATES = ("F", "O")
_LAT = "double(pmod({key} * 7919, 3400) + 403121) / 10000d"
_LON = "double(pmod({key} * 104729, 2993) - 38666) / 10000d"

# Columns in use; given to the reader so that it need not open files to find out.
TABLES = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double,
                   l_returnflag string, l_linestatus string""",
    "part": "p_partkey bigint, p_size int",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz""",
    "customer": "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", schema=TABLES[name])


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Totals per order, and per kind of line for the nested items."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    sized = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "volume", F.col("l_quantity") * F.col("p_size")
    )
    sums = ["sum(l_quantity) AS total_weight", "sum(volume) AS total_volume"]
    for flag in RETURN_FLAGS:
        sums.append(f"max(l_extendedprice) FILTER (WHERE l_returnflag = '{flag}') AS price_{flag}")
        for state in LINE_STATES:
            kind = f"l_returnflag = '{flag}' AND l_linestatus = '{state}'"
            sums.append(f"sum(l_quantity) FILTER (WHERE {kind}) AS weight_{flag}{state}")
            sums.append(f"sum(volume) FILTER (WHERE {kind}) AS volume_{flag}{state}")
    return sized.groupBy("l_orderkey").agg(*[F.expr(text) for text in sums])


def _package(flag: str, number: int) -> str:
    kind = f"{flag}{LINE_STATES[number]}"
    return f"""named_struct(
        'package_id', order_id || '-{kind}', 'subpackage_id', {number + 1},
        'quantity', int(weight_{kind}), 'weight', weight_{kind}, 'volume', volume_{kind})"""


def _item(flag: str) -> str:
    packages = ", ".join(_package(flag, number) for number in range(len(LINE_STATES)))
    quantity = " + ".join(f"coalesce(weight_{flag}{state}, 0)" for state in LINE_STATES)
    return f"""named_struct(
        'product_id', order_id || '-{flag}', 'product_name', 'lines {flag}', 'price', price_{flag},
        'quantity', int({quantity}), 'packages', filter(array({packages}), p -> p.weight IS NOT NULL))"""


_ORDER_DETAILS = f"""named_struct(
    'customer_id', '{config.CUSTOMER_PREFIX}' || o_custkey,
    'order_timestamp', at,
    'order_date', substring(at, 1, 10),
    'items', filter(array({", ".join(_item(flag) for flag in RETURN_FLAGS)}), i -> i.quantity > 0),
    'total_amount', o_totalprice,
    'total_volume', total_volume,
    'total_weight', total_weight,
    'status', '{config.RECEIVED}',
    'destination_address', named_struct(
        'address_id', 'adr-' || o_custkey, 'neighborhood', string(null), 'coordinates', array(lat, lon),
        'road', 'Main road', 'house_number', string(pmod(o_custkey, 200)), 'suburb', string(null),
        'city_district', string(null), 'state', string(null), 'postcode', string(null), 'country', 'Spain',
        'lat', lat, 'lon', lon),
    'payment_details', named_struct(
        'payment_method', 'Credit Card',
        'payment_status', if(o_orderstatus = 'P', 'PENDING', '{config.PAID}'),
        'transaction_id', 'trx-' || o_orderkey))"""


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """One nested event per order that has lines."""
    orders = table(spark, folder, "orders")
    joined = orders.join(order_lines(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"))
    keyed = joined.selectExpr(
        "*",
        "'ord-' || o_orderkey AS order_id",
        "date_format(timestamp(o_orderdate) + make_dt_interval(0, 0, 0, pmod(o_orderkey, 86400)),"
        f" '{times.ORDER_FORMAT}') AS at",
        f"{_LAT.format(key='o_custkey')} AS lat",
        f"{_LON.format(key='o_custkey')} AS lon",
    )
    return keyed.selectExpr(
        "'evt-' || o_orderkey AS event_id",
        "'ORDER_CREATED' AS event_type",
        "at AS event_timestamp",
        "order_id",
        f"{_ORDER_DETAILS} AS order_details",
    )


def paid_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Gold orders of the given tables, with the month they are packed under."""
    gold = gold_orders(silver_orders(order_events(spark, folder)))
    return gold.withColumn("month", F.date_trunc("month", "order_timestamp"))


def flat_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Flat orders, paid or not."""
    silver = silver_orders(order_events(spark, folder))
    return silver.select(
        "order_id",
        F.col("order_details_customer_id").alias("customer_id"),
        F.col("order_details_total_weight").alias("total_weight"),
        F.col("order_details_total_volume").alias("total_volume"),
        F.col("order_details_total_amount").alias("total_price"),
        "order_timestamp",
        F.col("order_details_status").alias("status"),
        "lat",
        "lon",
    )


def clients(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    key = F.col("c_custkey")
    return customer.select(
        key.alias("client_id"),
        F.col("c_name").alias("address"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("inactive").alias("status"),
        F.col("c_mktsegment").alias("points"),
        F.expr(_LAT.format(key="c_custkey")).alias("lat"),
        F.expr(_LON.format(key="c_custkey")).alias("lon"),
    )


def _clock(minute: Column) -> Column:
    hour, rest = F.floor(minute / 60), F.pmod(minute, F.lit(60))
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(rest.cast("string"), 2, "0"))


def routed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Paid orders with the run, driver and arrival a solver might have given them."""
    number = F.regexp_extract("order_id", r"(\d+)$", 1).cast("bigint")
    gold = paid_orders(spark, folder).select("order_id", "customer_id", "total_weight", number.alias("number"))
    number = F.col("number")
    return gold.select(
        ((number - F.pmod(number, F.lit(RUN_SIZE))) / RUN_SIZE).cast("bigint").alias("run"),
        (F.pmod(number, F.lit(BUSY_DRIVERS)) + 1).alias("driver"),
        (F.lit(540) + F.pmod(number * 7, F.lit(540))).alias("minute"),
        (F.pmod(number, F.lit(50)) == 0).alias("unserved"),
        "order_id",
        "customer_id",
        "total_weight",
    )


def solutions(spark: SparkSession, folder: str) -> DataFrame:
    """One route solution per run, in the layout of :data:`parcelflow.schemas.SOLUTION`."""
    # Rows of a run are brought together once; both groupings below then work in place.
    routed = routed_orders(spark, folder).repartition("run")
    fleet = config.Fleet()
    depots = F.array(*[F.struct(F.lit(d.id).alias("id"), F.lit(d.name).alias("name")) for d in config.DEPOTS])
    depot = F.element_at(depots, (F.floor((F.col("driver") - 1) / fleet.drivers_per_depot) + 1).cast("int"))

    def stop(location: Column, name: Column, arrival: Column, finish: Column, distance: Column) -> Column:
        return F.struct(
            location.alias("location_id"),
            name.alias("location_name"),
            arrival.alias("arrival_time"),
            finish.alias("finish_time"),
            distance.alias("distance"),
        )

    visit = stop(
        F.col("order_id"),
        F.col("customer_id"),
        _clock(F.col("minute")),
        _clock(F.col("minute") + 5),
        F.col("total_weight"),
    )
    served, late = ~F.col("unserved"), ~F.col("unserved") & (F.col("minute") > LATE_MINUTE)
    by_driver = routed.groupBy("run", "driver").agg(
        F.array_sort(F.collect_list(F.when(served, F.struct("minute", "order_id", visit.alias("visit"))))).alias("visits"),
        F.sort_array(F.collect_list(F.when(F.col("unserved"), F.col("order_id")))).alias("unserved"),
        F.sum(F.when(served, F.col("total_weight"))).alias("distance"),
        F.count_if(late).alias("late"),
        F.sum(F.when(late, F.col("minute") - LATE_MINUTE)).alias("lateness"),
    )
    distance = F.coalesce("distance", F.lit(0.0)) + F.lit(1.0)
    route = F.concat(
        F.array(stop(depot["id"], depot["name"], F.lit("09:00"), F.lit("09:00"), F.lit(0.0))),
        F.transform("visits", lambda entry: entry["visit"]),
        F.array(stop(depot["id"], depot["name"], F.lit("18:30"), F.lit("18:30"), F.lit(1.0))),
    )
    name = F.concat(F.lit("driver_"), F.col("driver").cast("string"))
    entry = F.struct(
        name.alias("driver_id"),
        route.alias("route"),
        distance.alias("distance"),
        F.col("late").alias("late"),
    )
    runs = by_driver.groupBy("run").agg(
        F.array_sort(F.collect_list(entry)).alias("drivers"),
        F.sum(distance).alias("total_distance"),
        F.sum("late").alias("num_late_visits"),
        F.sum(F.coalesce("lateness", F.lit(0))).alias("total_visit_lateness"),
        F.sum(F.size("visits")).alias("served"),
        F.sort_array(F.flatten(F.collect_list("unserved"))).alias("unserved"),
    )

    def per_driver(value) -> Column:
        return F.map_from_entries(F.transform("drivers", lambda d: F.struct(d["driver_id"], value(d))))

    run = F.col("run")
    at = F.lit(FIRST_RUN).cast("timestamp") + F.make_dt_interval(secs=F.pmod(run * RUN_SPACING, F.lit(RUN_SPAN)))
    finished_at = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    output = F.struct(
        F.lit("success").alias("status"),
        F.lit(0).cast("bigint").alias("total_break_time"),
        (F.col("served") % 7).cast("bigint").alias("total_idle_time"),
        (F.col("served") * 5).cast("bigint").alias("total_travel_time"),
        F.col("num_late_visits").alias("total_vehicle_overtime"),
        F.col("total_visit_lateness").cast("bigint").alias("total_visit_lateness"),
        (F.col("served") * 10).cast("bigint").alias("total_working_time"),
        F.col("num_late_visits"),
        F.size("unserved").cast("bigint").alias("num_unserved"),
        F.col("total_distance"),
        F.array_join("unserved", ",").alias("unserved"),
        per_driver(lambda d: d["distance"]).alias("distances"),
        per_driver(lambda d: d["late"]).alias("vehicle_overtime"),
        per_driver(lambda d: d["route"]).alias("solution"),
        F.lit(6).cast("bigint").alias("pl_precision"),
        per_driver(lambda d: F.transform(d["route"], lambda s: s["location_id"])).alias("polylines"),
    )
    return runs.select(
        F.concat(F.lit("run-"), run.cast("string")).alias("id"),
        F.lit("finished").alias("status"),
        finished_at.alias("finished_at"),
        F.struct(F.when(F.pmod(run, F.lit(10)) != 9, finished_at).alias("finishedProcessingAt")).alias("timing"),
        F.concat(F.lit("request-"), run.cast("string")).alias("input"),
        F.lit("madrid").alias("region"),
        output.alias("output"),
    )

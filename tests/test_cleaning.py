"""Order cleaning and expressions on hand-written rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelflow import config, schemas
from parcelflow.functions import geo, numbers, text, times
from parcelflow.operators import flatten, orders


def one(spark, column, **values):
    columns = [F.lit(value).alias(name) for name, value in values.items()] or [F.lit(1).alias("one")]
    return spark.range(1).select(*columns).select(column.alias("value")).first()["value"]


def event(order_id="ord-1", at="2024-10-05 18:14:59", lat=40.5, lon=-3.6, payment="PAID"):
    return {
        "event_id": "e1",
        "event_type": "ORDER_CREATED",
        "event_timestamp": at,
        "order_id": order_id,
        "order_details": {
            "customer_id": "cus-1",
            "order_timestamp": at,
            "order_date": "2024-10-05",
            "items": [{"product_id": "p", "price": 2.0, "quantity": 1, "packages": [{"package_id": "k", "weight": 1.0}]}],
            "total_amount": 10.0,
            "total_volume": 20.0,
            "total_weight": 30.0,
            "status": "RECEIVED",
            "destination_address": {"lat": lat, "lon": lon, "coordinates": [lat, lon]},
            "payment_details": {"payment_status": payment},
        },
    }


def events(spark, *rows):
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
    return lines.select(F.from_json("value", schemas.EVENT).alias("e")).select("e.*")


def test_silver_flattens_structs_and_keeps_arrays(spark):
    silver = orders.silver_orders(events(spark, event()))
    assert len(silver.columns) == 31 and "order_details_destination_address_coordinates" in silver.columns
    assert dict(silver.dtypes)["order_details_items"].startswith("array<struct<product_id:string")
    row = silver.first()
    assert row.order_timestamp == datetime(2024, 10, 5, 18, 14, 59)
    assert row.depot == "San Sebastian de los Reyes"


def test_gold_keeps_paid_orders_and_survives_bad_times(spark):
    silver = orders.silver_orders(events(spark, event(), event("ord-2", payment="PENDING"), event("ord-3", at="soon")))
    gold = orders.gold_orders(silver)
    rows = {row.order_id: row for row in gold.collect()}
    assert set(rows) == {"ord-1", "ord-3"}
    assert rows["ord-1"].hour == datetime(2024, 10, 5, 18) and rows["ord-3"].hour is None
    assert [name for name, _ in gold.dtypes] == [
        "order_id", "customer_id", "total_weight", "total_volume", "total_price", "order_timestamp", "status",
        "lat", "lon", "depot", "hour",
    ]
    assert orders.ready_orders(gold).select("status").distinct().first()[0] == config.READY


NEAR = [
    (40.54510, -3.61184, "San Sebastian de los Reyes"),
    (40.350370, -3.855863, "Alcorcón"),
    (40.36977, -3.59670, "Vallecas"),
    (None, -3.6, None),
    (40.5, None, None),
    (float("nan"), -3.6, None),
    (40.5, float("inf"), None),
]


@pytest.mark.parametrize("lat,lon,depot", NEAR)
def test_nearest_depot(spark, lat, lon, depot):
    rows = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert rows.select(geo.nearest_depot(F.col("lat"), F.col("lon"))).first()[0] == depot


def test_first_depot_wins_a_tie(spark):
    depots = [config.Depot("a", "left", 0.0, 0.0), config.Depot("b", "right", 0.0, 2.0)]
    assert one(spark, geo.nearest_depot(F.lit(0.0), F.lit(1.0), depots)) == "left"
    assert one(spark, geo.nearest_depot(F.lit(0.0), F.lit(1.0), depots[::-1])) == "right"


@pytest.mark.parametrize(
    "at,label",
    [
        ("2024-10-05T18:14:59.9Z", "2024-10-05-18-00"),
        ("2024-10-05T18:15:00Z", "2024-10-05-18-30"),
        ("2024-10-05T18:45:00Z", "2024-10-05-19-00"),
        ("2024-10-05T23:50:00Z", "2024-10-06-00-00"),
        ("nonsense", None),
        (None, "UNKNOWN"),
    ],
)
def test_half_hour_label(spark, at, label):
    rows = spark.createDataFrame([(at,)], "at string")
    assert rows.select(times.half_hour_label(F.col("at"), "UNKNOWN")).first()[0] == label


def test_other_times(spark):
    at = F.lit("2024-10-05 18:14:59").cast("timestamp")
    assert one(spark, times.hour_label(at)) == "24-10-05-18"
    assert one(spark, times.file_label(at)) == "2024-10-05_18-14-59"
    assert one(spark, times.next_day(at)) == date(2024, 10, 6)
    day = F.lit("2024-10-05").cast("date")
    assert one(spark, times.clock_on_next_day(day, F.lit("9:05"))) == datetime(2024, 10, 6, 9, 5)
    assert one(spark, times.clock_on_next_day(day, F.lit("late"))) is None
    assert one(spark, times.parsed(F.lit("2024-13-40 00:00:00"))) is None


def test_text_and_numbers(spark):
    assert one(spark, text.identifier(F.lit("2024-10-05T18:15:00.1"))) == "2024_10_05T18_15_00_1"
    assert one(spark, text.file_safe(F.lit("10:05 pm"))) == "10-05-pm"
    assert one(spark, text.path_element(F.lit("silver/batching/job-7/batch.json"), -2)) == "job-7"
    assert one(spark, text.path_element(F.lit("a"), -2)) is None
    assert one(spark, numbers.clamped(F.lit(7.0), 5.0)) == 5.0
    assert one(spark, numbers.whole_load(F.lit(2.1))) == 3
    assert one(spark, numbers.rounded_lon(F.lit(-3.12345678))) == -3.1234568
    assert one(spark, numbers.capacity_number(F.lit(None).cast("double"), F.lit(10.0), config.PACK_LIMITS)) == 1


def test_statuses(spark):
    assert one(spark, orders.promoted(F.lit("RECEIVED"))) == "READY_FOR_DELIVERY"
    assert one(spark, orders.promoted(F.lit("DISPATCHED"))) == "DISPATCHED"


def test_struct_reshaping(spark):
    rows = spark.sql("SELECT named_struct('a', 1, 'b', named_struct('c', 2), 'list', array(1)) AS s, 5 AS k")
    assert flatten.flatten_structs(rows).first().asDict() == {"s_a": 1, "s_b_c": 2, "s_list": [1], "k": 5}
    assert flatten.unnest(rows, "s", ["list"], ["k"]).columns == ["s_a", "s_b", "k"]
    assert flatten.drop_fields(rows, "s", "a", "list").select("s.*").columns == ["b"]
    place = spark.sql("SELECT map('address', 'x', 'lat', '1.5', 'lon', 'no') AS m")
    assert place.select(flatten.typed_location(F.col("m")).alias("p")).select("p.*").first().asDict() == {
        "address": "x", "lat": 1.5, "lon": None,
    }

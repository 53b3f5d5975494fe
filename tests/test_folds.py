"""Groupings whose result depends on all earlier rows, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow.config import Limits
from parcelflow.operators import flushing
from parcelflow.operators.flushing import threshold_groups
from parcelflow.operators.lorries import lorry_loads, lorry_split, lorry_totals
from parcelflow.operators.packing import capacity_batches, window_members
from parcelflow.operators.slices import running_totals

START = datetime(2024, 10, 1)
ROWS = "depot string, order_timestamp timestamp, order_id string, total_weight double, total_volume double, status string"


def make_orders(spark, seed, count, seconds=100_000, hot=0.6, weights=(0.1, 0.2, 1.5, 3.0, 0.0), volumes=(0.1, 0.7, 2.0)):
    rnd = random.Random(seed)
    rows = [
        (
            "hot" if rnd.random() < hot else rnd.choice(["b", None, *(f"c{n}" for n in range(20))]),
            START + timedelta(seconds=rnd.randrange(seconds)),
            f"o{number:05d}",
            rnd.choice(weights),
            rnd.choice(volumes),
            "READY",
        )
        for number in range(count)
    ]
    return rows, spark.createDataFrame(rows, ROWS)


def flushed(rows, limits):
    numbers, open_groups = {}, {}
    for key, at, order_id, weight, volume, _ in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        number, sum_weight, sum_volume, since = open_groups.get(key, (0, 0, 0, at))
        sum_weight, sum_volume = sum_weight + round((weight or 0) * 1e6), sum_volume + round((volume or 0) * 1e6)
        numbers[order_id] = number
        aged = limits.seconds is not None and (at - since).total_seconds() >= limits.seconds
        if sum_weight >= limits.weight * 1e6 or sum_volume >= limits.volume * 1e6 or aged:
            open_groups[key] = (number + 1, 0, 0, at)
        else:
            open_groups[key] = (number, sum_weight, sum_volume, since)
    return numbers


@pytest.mark.parametrize(
    "limits", [Limits(20, 30, 500.0), Limits(1, 1), Limits(1e9, 1e9), Limits(300, 200, 9000.0), Limits(0.3, 5)]
)
@pytest.mark.parametrize("slices", [None, 9])
def test_threshold_groups(spark, limits, slices):
    rows, orders = make_orders(spark, 7, 2000)
    got = threshold_groups(orders, limits=limits, slices=slices)
    assert {r.order_id: r.flush_id for r in got.collect()} == flushed(rows, limits)


@pytest.mark.parametrize("limits", [Limits(1e9, 700), Limits(900, 1e9, 40_000.0), Limits(1e9, 1e9, 30_000.0)])
def test_groups_over_many_slices(spark, limits):
    rows, orders = make_orders(spark, 11, 3000, hot=0.9)
    got = threshold_groups(orders, limits=limits, slices=40)
    assert {r.order_id: r.flush_id for r in got.collect()} == flushed(rows, limits)


def test_a_key_without_release_has_no_places(spark, monkeypatch):
    """Only totals of its slices travel, however many orders it has."""
    seen = []
    followed = flushing._followed
    monkeypatch.setattr(flushing, "_followed", lambda places, found, longest: seen.append((places.count(), found.count())) or followed(places, found, longest))
    _, orders = make_orders(spark, 3, 20_000, hot=1.0)
    got = threshold_groups(orders, limits=Limits(1e9, 1e9), slices=12)
    assert {r.flush_id for r in got.select("flush_id").distinct().collect()} == {0} and got.count() == 20_000
    assert seen == [(1, 0)]


def test_threshold_groups_keep_columns_and_mark_status(spark):
    _, orders = make_orders(spark, 1, 20)
    got = threshold_groups(orders)
    assert got.columns == [*orders.columns, "flush_id"]
    assert {r.status for r in got.collect()} == {"READY_FOR_DISPATCH"}


def loaded(rows, length, limits):
    room, result = {}, {}
    for _, at, order_id, weight, volume, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        window = int((at - datetime(1970, 1, 1)).total_seconds()) // length
        left_weight, left_volume = room.get(window, (limits.weight, limits.volume))
        fits = weight <= left_weight and volume <= left_volume
        result[order_id] = fits
        if fits:
            room[window] = (left_weight - weight, left_volume - volume)
    return result


@pytest.mark.parametrize("group_limit,slices", [(10_000, None), (200, None), (40, 5)])
def test_lorry_loads_in_rounds(spark, group_limit, slices):
    """Whole numbers, sizes from nothing to more than a lorry, one window with most of the rows."""
    rnd = random.Random(3)
    sizes = [0.0, 1.0, 2.0, 3.0, 7.0, 20.0, 45.0, 60.0, 130.0]
    rows = [
        (None, START + timedelta(seconds=rnd.choice([rnd.randrange(600), rnd.randrange(6000)])), f"o{n:05d}", s, v, "READY")
        for n, (s, v) in enumerate((rnd.choice(sizes), rnd.choice(sizes)) for _ in range(1500))
    ]
    limits = Limits(100.0, 120.0)
    orders = spark.createDataFrame(rows, ROWS)
    got = lorry_loads(orders, "10 minutes", limits, group_limit=group_limit, slices=slices)
    assert {r.order_id: r.loaded for r in got.collect()} == loaded(rows, 600, limits)


def test_lorry_split_and_lists(spark):
    rows, orders = make_orders(spark, 5, 300, weights=(10.0, 30.0), volumes=(5.0, 50.0))
    orders = orders.withColumns({"customer_id": F.lit("cus-1"), "lat": F.lit(1.0), "lon": F.lit(2.0)})
    split = lorry_split(lorry_loads(orders, "1 hour", Limits(60.0, 80.0)))
    assert split.count() == 300
    want = loaded(rows, 3600, Limits(60.0, 80.0))
    assert {r.order_id: r.status == "READY_FOR_DISPATCH" for r in split.collect()} == want
    totals = lorry_totals(split).collect()
    assert sum(row.orders for row in totals) == 300
    for row in totals:
        if row.status == "READY_FOR_DISPATCH":
            assert row.total_weight <= 60.0 and row.total_volume <= 80.0


@pytest.mark.parametrize("slices", [1, 7])
def test_running_totals_in_slices(spark, slices):
    _, orders = make_orders(spark, 2, 1500, weights=(1.0, 2.0, None), volumes=(1.0, 5.0))
    totals = {"w": "total_weight", "v": "total_volume"}
    plain = running_totals(orders, ["depot"], ["order_timestamp", "order_id"], totals)
    sliced = running_totals(orders, ["depot"], ["order_timestamp", "order_id"], totals, slices=slices)
    assert plain.exceptAll(sliced).isEmpty() and sliced.exceptAll(plain).isEmpty()


def test_running_totals_choose_slices_for_a_large_group(spark):
    _, orders = make_orders(spark, 2, 1500, weights=(1.0, 2.0), volumes=(1.0, 5.0))
    totals = {"w": "total_weight"}
    large = running_totals(orders, ["depot"], ["order_timestamp", "order_id"], totals, group_limit=100)
    small = running_totals(orders, ["depot"], ["order_timestamp", "order_id"], totals)
    assert "_slice" in large._jdf.queryExecution().toString() and "_slice" not in small._jdf.queryExecution().toString()
    assert large.exceptAll(small).isEmpty() and large.count() == small.count()


def test_capacity_batches_edges(spark):
    """An order above capacity skips numbers; orders of no size come first as batch 0."""
    rows = [
        (None, START, "a", 0.0, 0.0, "READY"),
        (None, START + timedelta(seconds=1), "b", 2500.0, 1.0, "READY"),
        (None, START + timedelta(seconds=2), "c", 500.0, 1.0, "READY"),
        (None, START + timedelta(seconds=3), "d", 1.0, 15_000.0, "READY"),
        (None, START + timedelta(seconds=3), "e", 1.0, 1.0, "READY"),
    ]
    orders = spark.createDataFrame(rows, ROWS).withColumn("hour", F.date_trunc("hour", "order_timestamp"))
    got = capacity_batches(orders.withColumn("batch_id", F.lit(99)))
    assert got.columns == [*orders.columns, "batch_id"]
    # weight 3000 is exactly three capacities; volume 15002 and 15003 begin the fourth
    assert {r.order_id: r.batch_id for r in got.collect()} == {"a": 0, "b": 3, "c": 3, "d": 4, "e": 4}


def test_window_members_have_true_totals(spark):
    rows, orders = make_orders(spark, 4, 1000)
    members = window_members(orders, "1 hour").collect()
    assert len(members) == 1000
    for m in members:
        same = [r for r in rows if r[1].replace(minute=0, second=0) == m.window_start]
        assert m.window_orders == len(same) and m.accumulated_weight == pytest.approx(sum(r[3] for r in same))


def test_fractional_loads_do_not_depend_on_slices(spark):
    """Loads of one decimal: batches and lorries are the same, however the rows are cut."""
    rnd = random.Random(11)
    rows = [
        (None, START + timedelta(seconds=rnd.randrange(3600)), f"o{n:05d}", rnd.randrange(1, 100) / 10, rnd.randrange(1, 100) / 10, "READY")
        for n in range(4000)
    ]
    orders = spark.createDataFrame(rows, ROWS).withColumn("hour", F.date_trunc("hour", "order_timestamp"))
    limits = Limits(20.0, 50.3)
    found = set()
    for slices in (None, 1, 7, 50):
        batches = capacity_batches(orders, limits=limits, slices=slices)
        found.add(tuple(sorted((r.order_id, r.batch_id) for r in batches.collect())))
    assert len(found) == 1
    found = set()
    for group_limit, slices in ((10_000, None), (50, 7), (50, 50)):
        loads = lorry_loads(orders, "10 minutes", limits, group_limit=group_limit, slices=slices)
        found.add(tuple(sorted((r.order_id, r.loaded) for r in loads.collect())))
    assert len(found) == 1

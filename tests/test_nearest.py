"""Nearest depot by grid against all distances."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.nearest import with_nearest

DEPOT = "name string, place long, lat double, lng double"


def nearest(points, depots):
    out = {}
    for k, y, x in points:
        fits = [(abs(y - d[2]) + abs(x - d[3]), d[1], d[0]) for d in depots if None not in d[2:] and all(abs(v) < float("inf") for v in d[2:])] if None not in (y, x) and all(abs(v) < float("inf") for v in (y, x)) else []
        out[k] = (min(fits)[2], min(fits)[0]) if fits else (None, None)
    return out


def found(spark, points, depots):
    rows = with_nearest(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(depots, DEPOT))
    return {r.id: (r.depot, r.distance) for r in rows.collect()}


@pytest.mark.parametrize("kind", ["spread", "town", "far", "grid", "one place"])
def test_nearest_equals_all_distances(spark, kind):
    pick = random.Random(kind)
    span = {"spread": 10, "town": 0.01, "far": 1, "grid": 6, "one place": 0}[kind]
    depots = [(f"d{k}", k, 40 + pick.uniform(0, span), -4 + pick.uniform(0, span)) for k in range(200)]
    if kind == "grid":  # many ties
        depots = [(f"d{k}", k, 40.0 + k % 7, -4.0 + k // 7 % 7) for k in range(200)]
    if kind == "town":
        depots += [("lonely", -1, 44.0, 3.0)]
    away = 90 if kind == "far" else 0
    points = [(k, 40 + away + pick.uniform(-2, 8), -4 - away + pick.uniform(-2, 8)) for k in range(300)]
    points += [(1000 + k, 40.0 + k / 2, -4.0 + k / 2) for k in range(12)]
    assert found(spark, points, depots) == nearest(points, depots)


def test_odd_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    points = [(1, None, 1.0), (2, nan, 1.0), (3, 1.0, inf), (4, 1.0, 1.0), (4, 1.0, 1.0)]
    depots = [("a", 2, 1.0, 2.0), ("b", 1, 2.0, 1.0), ("c", 0, None, 1.0), ("d", 0, nan, 1.0), ("e", None, 5.0, 5.0)]
    assert found(spark, points, depots) == {1: (None, None), 2: (None, None), 3: (None, None), 4: ("b", 1.0)}
    assert found(spark, points, depots[2:4]) == dict.fromkeys((1, 2, 3, 4), (None, None))
    assert with_nearest(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(depots, DEPOT)).count() == 5


def test_a_hundred_thousand_depots(spark):
    depots = spark.range(100_000).select(F.concat(F.lit("d"), "id").alias("name"), F.col("id").alias("place"), (F.col("id") * 7919 % 99_991 / 5000).alias("lat"), (F.col("id") * 104_729 % 99_989 / 5000).alias("lng"))
    points = [(k, k * 0.37 % 20, k * 0.73 % 20) for k in range(40)]
    got = {r.id: (r.depot, r.distance) for r in with_nearest(spark.createDataFrame(points, "id long, lat double, lon double"), depots).collect()}
    assert got == nearest(points, [tuple(r) for r in depots.collect()])


def test_points_are_not_copied_to_the_cells_around(spark, monkeypatch):
    """Only depots are: of a round's tables the points have one row each, however many cells are looked into."""
    from parcelflow.operators import nearest as module

    plans, keep = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: plans.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or keep(df, label))
    assert len(found(spark, [(k, 1.0, 1.0) for k in range(5)], [("b", 1, 1.0, 1.0), ("a", 1, 1.0, 1.0), ("c", None, 1.0, 3.0)])) == 5
    text = next(plan for label, plan in plans if label == "nearest")
    lines = [(re.search(r"[A-Z]", line).start(), line) for line in text.splitlines()]
    copying = [k for k, (_, line) in enumerate(lines) if "Generate" in line]
    assert copying
    for k in copying:
        below = "".join(line for _, line in itertools.takewhile(lambda other: other[0] > lines[k][0], lines[k + 1 :]))
        assert "lat" in below and "_point" not in below, text


def test_no_table_of_depots_or_points_is_broadcast(spark, monkeypatch):
    """Spark would take these few for small; it takes a million depots' copies for small as well."""
    from parcelflow.operators import nearest as module

    plans, keep = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or keep(df, label))
    rows = with_nearest(spark.createDataFrame([(k, 1.0, 1.0) for k in range(5)], "id long, lat double, lon double"), spark.createDataFrame([("a", 1, 1.0, 1.0)], DEPOT))
    plans.append(("result", rows._jdf.queryExecution().executedPlan().toString()))
    joined = [plan for _, plan in plans if "Join" in plan]
    assert len(joined) == 2 and not any("Broadcast" in plan for plan in joined), joined


def test_depots_at_one_place(spark):
    depots = [("b", 1, 1.0, 1.0), ("a", 1, 1.0, 1.0), ("z", 0, 9.0, 9.0), ("y", 0, 9.0, 9.0)]
    assert found(spark, [(1, 1.0, 2.0), (2, 8.0, 9.0)], depots) == {1: ("a", 1.0), 2: ("y", 1.0)}

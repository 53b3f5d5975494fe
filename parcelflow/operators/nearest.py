"""Nearest depot from a table of any size, by Manhattan distance.

Depots are found by grid cell. In the first round a point looks into its own cell and the eight around it; every depot within
one cell's width is there, so a nearest one closer than that is proven. Points without proof look again with cells twice
as wide, until all are settled: no cross join, and points near depots, most of them, are done in the first rounds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.session import stored

#: Depots in a cell of the first round, about, were they spread evenly.
PER_CELL = 2


def _usable(lat: Column, lon: Column) -> Column:
    endless = F.lit(float("inf"))  # NaN sorts above it
    return F.coalesce((F.abs(lat) < endless) & (F.abs(lon) < endless), F.lit(False))


def _cell(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(width))


def with_nearest(points: DataFrame, depots: DataFrame, lat: str = "lat", lon: str = "lon", per_cell: int = PER_CELL) -> DataFrame:
    """``points`` with ``depot`` and ``distance``; NULL without coordinates or depots.

    ``depots`` has name, place, lat and lng; of equally near depots the one with the smallest place counts, then the smallest name.
    Depots without coordinates are left out. Cells are only as wide as they must be, so a point far away from all depots is the one that takes most rounds.
    """
    keyed = stored(points.withColumn("_point", F.monotonically_increasing_id()), "points")
    known = depots.where(_usable(F.col("lat"), F.col("lng"))).groupBy("lat", "lng")
    # Of depots at one place only the first in order can be a nearest one.
    sites = stored(known.agg(F.min(F.struct("place", "name")).alias("site")), "depots")
    low_lat, high_lat, low_lon, high_lon, many = sites.agg(F.min("lat"), F.max("lat"), F.min("lng"), F.max("lng"), F.count("*")).first()
    settled = keyed.where("false").select("_point", F.lit(None).cast("double").alias("distance"), F.lit(None).cast(depots.schema["name"].dataType).alias("depot"))
    if many:
        left = stored(keyed.where(_usable(F.col(lat), F.col(lon))).select("_point", F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x")), "open")
        spread = max(high_lat - low_lat, high_lon - low_lon)
        width = spread / math.sqrt(max(1, many / per_cell)) or 1e-9
        near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        while not left.isEmpty():
            # Depots, not points, are copied to the cells around: a point is moved once a round.
            placed = sites.select("*", near.alias("n")).select("lat", "lng", "site", (_cell(F.col("lat"), width) + F.col("n.i")).alias("row"), (_cell(F.col("lng"), width) + F.col("n.j")).alias("column"))
            distance = F.abs(F.col("y") - F.col("lat")) + F.abs(F.col("x") - F.col("lng"))

            def looked(rows: DataFrame) -> DataFrame:
                celled = rows.withColumns({"row": _cell(F.col("y"), width), "column": _cell(F.col("x"), width)})
                # Spark takes the nine copies for one, and their compressed file for their size: never broadcast by that.
                return celled.join(placed.hint("merge"), ["row", "column"], "left").withColumn("here", distance)

            # First the distance, a number that needs no sorting of all depots looked at; then which of the depots at it.
            closest = looked(left).groupBy("_point", "y", "x").agg(F.min("here").alias("distance"))
            tied = looked(closest).where(F.col("distance").isNull() | (F.col("here") == F.col("distance")))
            found = tied.groupBy("_point", "y", "x", "distance").agg(F.min("site").alias("site"))
            # One cell's width is proof; a little less, since borders are rounded.
            proven = F.coalesce(F.col("distance") < width * (1 - 1e-9), F.lit(False))
            found = stored(found.select("_point", "y", "x", "distance", F.col("site.name").alias("depot"), proven.alias("proven")), "nearest")
            settled = settled.unionByName(found.where("proven").select("_point", "distance", "depot"))
            left = found.where("not proven").select("_point", "y", "x")
            width *= 2
    return keyed.join(settled.hint("merge"), "_point", "left").drop("_point")  # a row a point

"""Nearest depot by Manhattan distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.config import DEPOTS, Depot


def manhattan(lat: Column, lon: Column, depot: Depot) -> Column:
    return F.abs(lat - F.lit(depot.lat)) + F.abs(lon - F.lit(depot.lng))


def nearest_depot(lat: Column, lon: Column, depots: Sequence[Depot] = DEPOTS) -> Column:
    """Name of the nearest configured depot; the first one wins a tie, no depot without coordinates.

    The depots are settings, so they become literals of the expression: no join and no Python worker.
    """
    ranked = F.array(
        *[
            F.struct(
                manhattan(lat, lon, depot).alias("distance"),
                F.lit(position).alias("position"),
                F.lit(depot.name).alias("name"),
            )
            for position, depot in enumerate(depots)
        ]
    )
    endless = F.lit(float("inf"))  # NaN sorts above it
    return F.when((F.abs(lat) < endless) & (F.abs(lon) < endless), F.array_min(ranked)["name"])

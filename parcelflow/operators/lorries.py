"""Load one lorry per window: in order, an order goes along if it still fits, else it stays behind.

Whether an order fits depends on all that was loaded before, so windows of usual size are walked
row by row. A window too large for one task is loaded in rounds, each of which is a plain parallel
job. In a round orders of more than half the free room in weight or volume are *big*, the others
*small*. As long as all small ones are loaded and no big one is, running totals of the small ones
tell the load at any place. The round ends at its first turn: a small order that does not fit, or a
big one that does. Either way less than half of the room is left afterwards, in weight or volume,
so the number of rounds grows with the logarithm of the room, not with the number of orders.

Loads are whole millionths of their unit, so both ways decide alike, whatever fractions the orders have.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from parcelflow.config import LORRY_LIMITS, READY_FOR_DISPATCH, RECEIVED, Limits
from parcelflow.functions.numbers import millionths
from parcelflow.operators.packing import FIFO
from parcelflow.operators.slices import (
    GROUP_LIMIT,
    group_key,
    group_sizes,
    key_runs,
    numbers_of,
    running_totals,
    with_result,
)
from parcelflow.session import stored

_WORK = ("_key", "_weight", "_volume", "_room_weight", "_room_volume")


def _load_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted rows; the first row of a window tells how much room there is."""
    key, weight_left, volume_left = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        weights, volumes = numbers_of(batch, "_weight"), numbers_of(batch, "_volume")
        loaded = []
        for run_key, start, end in key_runs(batch.column("_key")):
            if run_key != key:
                key = run_key
                weight_left = batch.column("_room_weight")[start].as_py()
                volume_left = batch.column("_room_volume")[start].as_py()
            for weight, volume in zip(weights[start:end], volumes[start:end], strict=True):
                fits = weight <= weight_left and volume <= volume_left
                loaded.append(fits)
                if fits:
                    weight_left -= weight
                    volume_left -= volume
        yield with_result(batch, "loaded", pa.array(loaded, pa.bool_()))


def _walk(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    kept = [field for field in rows.schema.fields if field.name not in _WORK]
    out = StructType(kept).add("loaded", BooleanType())
    return rows.repartition("_key").sortWithinPartitions("_key", *order).mapInArrow(_load_sorted, out)


def _fits(weight: Column, volume: Column) -> Column:
    return (weight <= F.col("_room_weight")) & (volume <= F.col("_room_volume"))


def _round(
    rows: DataFrame, order: Sequence[str], group_limit: int, slices: int | None
) -> tuple[list[DataFrame], DataFrame]:
    """Decided rows, with ``loaded``, and the rows after the turn with the room that is left."""
    weight, volume = F.col("_weight"), F.col("_volume")
    small = _fits(weight * 2, volume * 2)
    possible = rows.filter(_fits(weight, volume)).withColumns(
        {
            "_small": small,
            "_small_weight": F.when(small, weight).otherwise(0),
            "_small_volume": F.when(small, volume).otherwise(0),
            "_one": F.lit(1),
        }
    )
    sums = {"_sum_weight": "_small_weight", "_sum_volume": "_small_volume", "_place": "_one"}
    summed = stored(running_totals(possible, ["_key"], order, sums, group_limit, slices), "lorry-round")

    small, sum_weight, sum_volume = F.col("_small"), F.col("_sum_weight"), F.col("_sum_volume")
    turn = (small & ~_fits(sum_weight, sum_volume)) | (~small & _fits(sum_weight + weight, sum_volume + volume))
    turns = summed.filter(turn).groupBy("_key").agg(F.min("_place").alias("_turn"))
    placed = summed.join(turns, "_key", "left")
    until = F.col("_turn").isNull() | (F.col("_place") <= F.col("_turn"))
    loaded = small == (F.col("_turn").isNull() | (F.col("_place") < F.col("_turn")))
    decided = placed.filter(until).withColumn("loaded", loaded)

    taken = decided.filter("loaded").groupBy("_key").agg(
        F.sum("_weight").alias("_taken_weight"), F.sum("_volume").alias("_taken_volume")
    )
    left = placed.filter(~until).join(taken, "_key", "left")
    left = left.withColumns(
        {
            "_room_weight": F.col("_room_weight") - F.coalesce("_taken_weight", F.lit(0)),
            "_room_volume": F.col("_room_volume") - F.coalesce("_taken_volume", F.lit(0)),
        }
    ).select(*rows.columns)
    never = rows.filter(~_fits(weight, volume)).withColumn("loaded", F.lit(False))
    kept = [name for name in rows.columns if name not in _WORK]
    return [part.select(*kept, "loaded") for part in (never, decided)], left


def lorry_loads(
    orders: DataFrame,
    length: str = "10 minutes",
    limits: Limits = LORRY_LIMITS,
    order: Sequence[str] = FIFO,
    at: str = "order_timestamp",
    group_limit: int = GROUP_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Orders with their window and whether they are ``loaded``; NULL weighs nothing."""
    rows = orders.withColumn("window_start", F.window(at, length)["start"])
    work = rows.withColumns(
        {
            "_key": group_key(["window_start"]),
            "_weight": millionths(F.coalesce(F.col("total_weight").cast("double"), F.lit(0.0))),
            "_volume": millionths(F.coalesce(F.col("total_volume").cast("double"), F.lit(0.0))),
            "_room_weight": millionths(F.lit(limits.weight)),
            "_room_volume": millionths(F.lit(limits.volume)),
        }
    )
    decided: list[DataFrame] = []
    while group_sizes(work, ["_key"])[0] > group_limit:
        done, left = _round(work, order, group_limit, slices)
        decided.extend(done)
        work = stored(left, "lorry-left")
    return reduce(DataFrame.unionByName, [*decided, _walk(work, order)])


def lorry_split(loads: DataFrame) -> DataFrame:
    """Loaded orders as ready for dispatch, the others as received again; one pass over the loads."""
    state = F.when(F.col("loaded"), F.lit(READY_FOR_DISPATCH)).otherwise(F.lit(RECEIVED))
    return loads.withColumn("status", state).drop("loaded")


def lorry_totals(split: DataFrame) -> DataFrame:
    """Totals of each window's loaded orders and of those left behind; the orders themselves stay rows."""
    return split.groupBy("window_start", "status").agg(
        F.count("*").alias("orders"), F.sum("total_volume").alias("total_volume"), F.sum("total_weight").alias("total_weight")
    )

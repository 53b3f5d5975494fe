"""Accumulate orders until a threshold is met, release them all, start again.

The group number of an order depends on every earlier order of its key, so no window function can
give it. Prefix sums tell for every order at once where a group that opens with it is released; the
walk then goes from release to release, not from order to order. Loads are whole millionths and
times whole microseconds, so sums don't depend on where they begin. Spark shuffles and sorts. A key
too large for one task is cut into slices which are walked in parallel:

1. Whoever enters a slice with orders already waiting releases them at one of the slice's first orders, at the latest where
   somebody entering empty-handed would. So only these few orders are places at which a group that began earlier can end.
   For each, its slice tells how it is left, and totals of all slices tell in which later slice the group then open ends.
2. That slice finds the order. This gives a pointer from each place to the next one; pointers that no orders before could
   reach are never made.
3. Pointers are doubled in rounds of joins, as many as the logarithm of the slices, and followed from where each key begins. The
   places so reached tell with which waiting totals each slice is entered.
4. Knowing that, all slices are numbered at once; the entries are a table that is joined by slice.

A group may span any number of slices: to a task go its slice's orders, the pointers that end there, and totals of slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from parcelflow.config import FLUSH_LIMITS, READY_FOR_DISPATCH, Limits
from parcelflow.functions.numbers import millionths
from parcelflow.operators.orders import with_status
from parcelflow.operators.packing import FIFO
from parcelflow.operators.slices import (
    GROUP_LIMIT,
    group_key,
    group_sizes,
    key_runs,
    slices_for,
    sorted_slices,
    with_result,
)
from parcelflow.session import stored

_NEVER = np.iinfo(np.int64).max // 4


@dataclass(frozen=True)
class Waiting:
    """The open group of one key: its number, its totals and the time of the release before it."""

    number: int = 0
    weight: int = 0
    volume: int = 0
    since: int | None = None


@dataclass(frozen=True)
class Bounds:
    """Limits in millionths of a unit, and microseconds."""

    weight: int
    volume: int
    age: int


def bounds(limits: Limits) -> Bounds:
    def whole(value: float) -> int:
        return min(_NEVER, round(value * 1e6))

    return Bounds(whole(limits.weight), whole(limits.volume), _NEVER if limits.seconds is None else whole(limits.seconds))


class Orders:
    """Orders of one key in order of time, as prefix sums."""

    def __init__(self, weights: np.ndarray, volumes: np.ndarray, times: np.ndarray, limits: Bounds):
        self.n, self.limits, self.times = len(times), limits, times
        self.weights = np.concatenate(([0], np.cumsum(weights)))
        self.volumes = np.concatenate(([0], np.cumsum(volumes)))
        self.next = self._successors()

    def _successors(self) -> list[int]:
        """For each order where a group that opens with it, just after a release, is released; n if it isn't."""
        start = np.arange(self.n)
        by_weight = np.searchsorted(self.weights, self.weights[:-1] + self.limits.weight) - 1
        by_volume = np.searchsorted(self.volumes, self.volumes[:-1] + self.limits.volume) - 1
        before = np.concatenate((self.times[:1], self.times[:-1]))
        by_age = np.searchsorted(self.times, before + self.limits.age)
        return np.maximum(np.minimum(np.minimum(by_weight, by_volume), by_age), start).tolist()

    def first_release(self, waiting: Waiting) -> int:
        """Where those waiting are released together with the first orders; n if they aren't."""
        since = int(self.times[0]) if waiting.since is None else waiting.since
        by_weight = np.searchsorted(self.weights, self.limits.weight - waiting.weight) - 1
        by_volume = np.searchsorted(self.volumes, self.limits.volume - waiting.volume) - 1
        by_age = np.searchsorted(self.times, since + self.limits.age)
        return max(0, int(min(by_weight, by_volume, by_age)))

    def open_since(self, start: int, number: int) -> Waiting:
        """The group that opened with ``start``, just after a release, as it waits after the last order."""
        return Waiting(
            number,
            int(self.weights[-1] - self.weights[start]),
            int(self.volumes[-1] - self.volumes[start]),
            int(self.times[start - 1]),
        )

    def numbers(self, waiting: Waiting) -> tuple[np.ndarray, Waiting]:
        """Group number of every order, and what is waiting after the last one."""
        given = np.full(self.n, waiting.number, dtype=np.int64)
        end = self.first_release(waiting)
        if end >= self.n:
            since = int(self.times[0]) if waiting.since is None else waiting.since
            weight, volume = waiting.weight + int(self.weights[-1]), waiting.volume + int(self.volumes[-1])
            return given, Waiting(waiting.number, weight, volume, since)
        heads = []
        while end < self.n:
            heads.append(start := end + 1)
            end = self.next[start] if start < self.n else self.n
        inside = np.zeros(self.n + 1, dtype=np.int64)
        inside[heads] = 1
        return given + np.cumsum(inside[:-1]), self.open_since(heads[-1], waiting.number + len(heads))

    def ends(self) -> tuple[list[int], list[int]]:
        """For each order that opens a group: the releases from there on, and the order that opens the last group."""
        count, opened = [0] * (self.n + 1), list(range(self.n + 1))
        for start in range(self.n - 1, -1, -1):
            end = self.next[start]
            if end < self.n:
                count[start], opened[start] = count[end + 1] + 1, opened[end + 1]
        return count, opened


def _orders(batch: pa.RecordBatch | pa.Table, start: int, end: int, limits: Bounds) -> Orders:
    return Orders(*(batch.column(name).slice(start, end - start).to_numpy() for name in ("_weight", "_volume", "_at")), limits)


def _number_sorted(limits: Bounds, name: str):
    """Map function over sorted partitions: a new key, or a new slice, starts afresh or with what enters it."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, waiting = None, Waiting()
        for batch in batches:
            if not batch.num_rows:
                continue
            given = []
            for key, start, end in key_runs(batch.column("_run")):
                if key != run:
                    run, waiting = key, Waiting()
                    if "_number" in batch.schema.names and batch.column("_number")[start].is_valid:
                        waiting = Waiting(*(batch.column(c)[start].as_py() for c in ("_number", "_enter_weight", "_enter_volume", "_since")))
                numbered, waiting = _orders(batch, start, end, limits).numbers(waiting)
                given.append(numbered)
            yield with_result(batch, name, pa.array(np.concatenate(given)))

    return number


@dataclass(frozen=True)
class Span:
    """Totals of a key that lies in several slices, slice by slice: up to each slice's end, and its last time."""

    slices: np.ndarray
    weights: np.ndarray
    volumes: np.ndarray
    last: np.ndarray
    first: int

    def before(self, place: int) -> tuple[int, int]:
        return (int(self.weights[place - 1]), int(self.volumes[place - 1])) if place else (0, 0)


def _spans(cut: DataFrame) -> dict[str, Span]:
    """Keys that lie in several slices. A slice shares its first and its last key at most, so there are two rows per slice."""
    parts = cut.groupBy("_key", "_slice").agg(
        F.sum("_weight").alias("w"), F.sum("_volume").alias("v"), F.min("_at").alias("first"), F.max("_at").alias("last")
    )
    shared = parts.groupBy("_key").count().where("count > 1").select("_key")
    rows = parts.join(shared, "_key").toPandas().sort_values(["_key", "_slice"])
    return {
        key: Span(part["_slice"].to_numpy(), part["w"].to_numpy().cumsum(), part["v"].to_numpy().cumsum(), part["last"].to_numpy(), int(part["first"].iat[0]))
        for key, part in rows.groupby("_key", sort=False)
    }


_PLACES = "_key string, _slice bigint, id bigint, number bigint, weight bigint, volume bigint, since bigint, target bigint"
_FOUND = "id bigint, next bigint"
_ENTRIES = "_slice bigint, _key string, _number bigint, _enter_weight bigint, _enter_volume bigint, _since bigint"


def _place_id(slice_number: int, position: int | np.ndarray) -> int | np.ndarray:
    """Number of an order's place among all slices; -1 is the beginning of a key."""
    return (slice_number << 32) + position + 1


def _places(limits: Bounds, shared):
    """Per slice: the orders at which a group that began earlier can end, and how the slice is left after each.

    ``weight``, ``volume`` and ``since`` are those of the group that is open at the slice's end, ``target`` is the slice where it ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        table, spans = pa.Table.from_batches(parts).combine_chunks(), shared.value
        runs = list(key_runs(table.column("_key").chunk(0)))
        slice_number = table.column("_slice")[0].as_py()
        for key, start, end in {runs[0], runs[-1]}:
            span = spans.get(key)
            if span is None:
                continue
            here = int(np.searchsorted(span.slices, slice_number))
            own = _orders(table, start, end, limits)
            if here == 0:  # the key begins here
                _, left = own.numbers(Waiting())
                ids, states = np.array([_place_id(slice_number, -1)]), np.array([[left.number, left.weight, left.volume, left.since]])
            else:
                weight, volume = span.before(here)
                # nobody enters with more than all that came before
                first = own.first_release(Waiting(0, weight, volume, span.first))
                positions = np.arange(first, min(own.first_release(Waiting()) + 1, own.n))
                if not len(positions):
                    continue
                count, opened = (np.array(x) for x in own.ends())
                opener = opened[positions + 1]
                ids = _place_id(slice_number, positions)
                states = np.stack([count[positions + 1], own.weights[-1] - own.weights[opener], own.volumes[-1] - own.volumes[opener], own.times[opener - 1]], axis=1)
            by_weight = np.searchsorted(span.weights, limits.weight - states[:, 1] + span.weights[here])
            by_volume = np.searchsorted(span.volumes, limits.volume - states[:, 2] + span.volumes[here])
            by_age = np.searchsorted(span.last, states[:, 3] + limits.age)
            at = np.maximum(np.minimum(np.minimum(by_weight, by_volume), by_age), here + 1)
            ends = at < len(span.slices)
            target = pa.array(span.slices[np.where(ends, at, 0)], mask=~ends)
            n = len(ids)
            columns = [pa.array([key] * n, pa.string()), pa.array(np.full(n, slice_number)), pa.array(ids), *(pa.array(states[:, k].astype(np.int64)) for k in range(4)), target]
            yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in _PLACES.split(", ")])

    return run


def _endings(limits: Bounds, shared):
    """Rows of (_slice, _kind, _at, ...): a slice's orders (0), then places whose groups end in it (1): the order at which each ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, own = None, [], None
        for batch in batches:
            slices, kinds = batch.column("_slice").to_numpy(), batch.column("_kind").to_numpy()
            borders = np.flatnonzero((np.diff(slices) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *borders], [*borders, batch.num_rows], strict=True):
                if start == end:
                    continue
                if slices[start] != current:
                    current, held, own = slices[start], [], None
                part = batch.slice(start, end - start)
                if kinds[start] == 0:
                    held.append(part)
                    continue
                if own is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    weights, volumes = (np.concatenate(([0], np.cumsum(table.column(c).to_numpy()))) for c in ("weight", "volume"))
                    own, times, held = (weights, volumes), table.column("since").to_numpy(), []
                weights, volumes = own
                span = shared.value[part.column("_key")[0].as_py()]
                here = int(np.searchsorted(span.slices, current))
                carried = np.array([span.before(int(k)) for k in np.searchsorted(span.slices, part.column("origin").to_numpy()) + 1])
                before = span.before(here)
                by_weight = np.searchsorted(weights, limits.weight - part.column("weight").to_numpy() - (before[0] - carried[:, 0])) - 1
                by_volume = np.searchsorted(volumes, limits.volume - part.column("volume").to_numpy() - (before[1] - carried[:, 1])) - 1
                by_age = np.searchsorted(times, part.column("since").to_numpy() + limits.age)
                at = np.maximum(np.minimum(np.minimum(by_weight, by_volume), by_age), 0)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(_place_id(int(current), at))], names=["id", "next"])

    return run


def _followed(places: DataFrame, found: DataFrame, longest: int) -> DataFrame:
    """Places that are reached from where their keys begin: id, and the number of the group open after it."""
    hops = stored(found.join(places.select(F.col("id").alias("next"), (F.col("number") + 1).alias("add")), "next").select("id", "next", "add"), "hops")
    doubled = [hops]
    while 1 << len(doubled) < longest and not doubled[-1].isEmpty():
        one = doubled[-1]
        two = one.select(F.col("id").alias("next"), F.col("next").alias("then"), F.col("add").alias("more"))
        doubled.append(stored(one.join(two, "next").select("id", F.col("then").alias("next"), (F.col("add") + F.col("more")).alias("add")), "hops"))
    reached = places.where(F.col("id").bitwiseAND(F.lit((1 << 32) - 1)) == 0).select("id", "number")
    for steps in reversed(doubled):
        further = reached.join(steps, "id").select(F.col("next").alias("id"), (F.col("number") + F.col("add")).alias("number"))
        reached = stored(reached.unionByName(further), "reached")
    return reached


def _entries(cut: DataFrame, limits: Bounds) -> DataFrame:
    """With which open group each slice is entered that goes on with the key of the slice before."""
    spark = cut.sparkSession
    spans = _spans(cut)
    if not spans:
        return spark.createDataFrame([], _ENTRIES)
    shared = spark.sparkContext.broadcast(spans)  # two rows per slice
    places = stored(cut.select("_slice", "_key", "_weight", "_volume", "_at").mapInArrow(_places(limits, shared), _PLACES), "places")
    asked = places.where("target is not null").select(
        F.col("target").alias("_slice"), F.lit(1).alias("_kind"), F.col("since").alias("_at"), F.col("id"), "_key", F.col("_slice").alias("origin"), "weight", "volume", "since"
    )
    # A slice's first orders are those of the key that goes on in it; rows of a partition are numbered in its order.
    numbered = cut.select("_slice", "_key", "_weight", "_volume", "_at").withColumn("id", F.monotonically_increasing_id())
    ends_here = asked.select("_slice", "_key").distinct()
    orders = numbered.join(ends_here, ["_slice", "_key"]).select(
        "_slice", F.lit(0).alias("_kind"), "_at", "id", "_key", F.lit(0).cast("bigint").alias("origin"), F.col("_weight").alias("weight"), F.col("_volume").alias("volume"), F.col("_at").alias("since")
    )
    both = orders.unionByName(asked).repartition("_slice").sortWithinPartitions("_slice", "_kind", "id")
    found = stored(both.mapInArrow(_endings(limits, shared), _FOUND), "endings")
    reached = _followed(places, found, max(len(span.slices) for span in spans.values()))
    left = places.drop("number").join(reached, "id").select("_key", "_slice", F.struct("number", "weight", "volume", "since", "_slice").alias("left"))
    rows = [
        (key, int(n), *span.before(k), *span.before(k + 1))
        for key, span in spans.items()
        for k, n in enumerate(span.slices)
    ]  # two rows per slice
    totals = spark.createDataFrame(rows, "_key string, _slice bigint, w0 bigint, v0 bigint, w1 bigint, v1 bigint")
    ended = totals.join(left, ["_key", "_slice"], "left").withColumn("left", F.when(F.col("left").isNotNull(), F.struct("left.*", "w1", "v1")))
    earlier = F.last("left", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    entered = ended.withColumn("e", earlier).where("e is not null")
    return entered.select(
        "_slice",
        "_key",
        F.col("e.number").alias("_number"),
        (F.col("e.weight") + F.col("w0") - F.col("e.w1")).alias("_enter_weight"),
        (F.col("e.volume") + F.col("v0") - F.col("e.v1")).alias("_enter_volume"),
        F.col("e.since").alias("_since"),
    )


def threshold_groups(
    orders: DataFrame,
    keys: Sequence[str] = ("depot",),
    limits: Limits = FLUSH_LIMITS,
    order: Sequence[str] = FIFO,
    at: str = "order_timestamp",
    group_limit: int = GROUP_LIMIT,
    slices: int | None = None,
    name: str = "flush_id",
) -> DataFrame:
    """Number the release each order goes out with, per key, from 0.

    A group is released with the order that brings its weight or volume to the limit, or that comes
    ``limits.seconds`` or more after the release before. Weights and volumes must not be negative and
    count to the millionth; NULL counts as nothing. ``order`` begins with ``at``. Orders of the last, still open group carry the next number.
    """
    if order[0] != at:
        raise ValueError(f"orders must be taken by {at!r} first, not by {order[0]!r}")
    columns = orders.columns
    prepared = orders.withColumns(
        {
            "_key": group_key(keys),
            "_weight": F.coalesce(millionths(F.col("total_weight").cast("double")), F.lit(0)),
            "_volume": F.coalesce(millionths(F.col("total_volume").cast("double")), F.lit(0)),
            "_at": F.unix_micros(F.col(at)),
        }
    )
    out = StructType([*orders.schema.fields]).add(name, LongType())
    largest, rows = group_sizes(orders, keys) if slices is None else (None, 0)
    whole = bounds(limits)
    if largest is not None and largest <= group_limit:
        by_key = prepared.withColumn("_run", F.col("_key")).repartition("_key").sortWithinPartitions("_key", *order)
    else:
        cut = sorted_slices(prepared, ["_key"], order, slices or slices_for(rows))
        entries = stored(_entries(cut, whole), "entries")
        entered = cut.join(entries, ["_slice", "_key"], "left").withColumn("_run", F.concat_ws("/", "_slice", "_key"))
        by_key = entered.repartition("_slice").sortWithinPartitions("_slice", "_key", *order)
    numbered = by_key.mapInArrow(_number_sorted(whole, name), out)
    return with_status(numbered.select(*columns, name), READY_FOR_DISPATCH) if "status" in columns else numbered

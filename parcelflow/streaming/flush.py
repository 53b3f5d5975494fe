"""Buffer orders per key until a threshold is met, then release them together.

A buffer's orders are in the stream's state in parts of bounded size, written once each; its totals are one small value beside
them. Parts are read only when they are released, one at a time. Loads count in whole millionths, as in the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parcelflow.config import FLUSH_LIMITS, READY_FOR_DISPATCH, Limits
from parcelflow.operators.flushing import Bounds, Orders, Waiting, bounds

RELEASED = (
    "key string, lane int, release bigint, order_id string, customer_id string, total_weight double,"
    " total_volume double, order_timestamp timestamp, status string"
)
_TOTALS = "release bigint, weight bigint, volume bigint, since_ms bigint, waiting bigint, parts bigint"
_ORDERS = pa.schema({"order_id": pa.string(), "customer_id": pa.string(), "total_weight": pa.float64(), "total_volume": pa.float64(), "order_timestamp": pa.timestamp("us")})
_COLUMNS = _ORDERS.names
#: Orders of a part of a buffer, at most.
PART_ROWS = 10_000
#: How often a waiting buffer looks at the clock for its cut-off.
_LOOK_MS = 60_000


def past_clock(now_ms: int, clock: str) -> bool:
    """Whether the time of day (UTC) has reached ``HH:MM``."""
    return datetime.fromtimestamp(now_ms / 1000, timezone.utc).strftime("%H:%M") >= clock


def _millionths(loads: pd.Series) -> np.ndarray:
    return np.rint(loads.fillna(0.0).to_numpy(dtype=np.float64) * 1e6).astype(np.int64)


def _packed(orders: pd.DataFrame) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _ORDERS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_pandas(orders, _ORDERS, preserve_index=False))
    return out.getvalue().to_pybytes()


def _unpacked(part: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(part).read_pandas()


class Buffer(StatefulProcessor):
    """Buffers of one key and lane. ``clock`` stands for the time of day, so that a past day can be run again.

    With ``per_order=False`` no more than a part of a buffer is held, however many orders come or wait.
    """

    def __init__(self, limits: Limits, per_order: bool, cutoff: str | None, clock: str | None):
        self.limits, self.per_order, self.cutoff, self.clock = limits, per_order, cutoff, clock
        self.timed = limits.seconds is not None or cutoff is not None  # a stream without timers has no clock either
        whole = bounds(limits)
        self.whole = Bounds(whole.weight, whole.volume, np.iinfo(np.int64).max // 4)  # age is wall-clock time here

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _TOTALS)
        # Not a list: RocksDB keeps and reads the list of a key as one value.
        self.parts = handle.getMapState("parts", "part bigint", "orders binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.timed else 0
        held = self.totals.get()
        release, weight, volume, since, waiting, parts = held if held is not None else (0, 0, 0, now, 0, 0)
        arrived = filter(len, rows)
        due = self._due(now, since)
        if not self.per_order:
            total, came = Waiting(release, weight, volume), 0
            for part in arrived:
                total = Waiting(release, total.weight + int(_millionths(part["total_weight"]).sum()), total.volume + int(_millionths(part["total_volume"]).sum()))
                came += len(part)
                if due:
                    yield self._out(key, part[_COLUMNS], release)
                else:
                    parts = self._put(part[_COLUMNS], parts)
            if not came:
                return
            if due or total.weight >= self.whole.weight or total.volume >= self.whole.volume:
                yield from self._taken(key, release, parts)
                self._keep(Waiting(release + 1), now, 0, 0, now)
            else:
                self._keep(total, since, waiting + came, parts, now)
            return
        arrived = list(arrived)
        if not arrived:
            return
        came = pd.concat(arrived)[_COLUMNS].sort_values(["order_timestamp", "order_id"], ignore_index=True)
        numbers, left = self._numbers(came, Waiting(release, weight, volume, 0), due, now, since)
        since = now if left.number > release else since
        # Those that waited go out with the first release; of the new ones all but the last, open group.
        gone = numbers < left.number
        if left.number > release:
            yield from self._taken(key, release, parts)
            waiting = parts = 0
            yield self._out(key, came[gone], numbers[gone])
        staying = came[~gone]
        self._keep(left, since, waiting + len(staying), self._put(staying, parts), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        release, weight, volume, since, waiting, parts = self.totals.get()
        if waiting and self._due(now, since):
            yield from self._taken(key, release, parts)
            self._keep(Waiting(release + 1), now, 0, 0, now)
        else:
            self._keep(Waiting(release, weight, volume), since, waiting, parts, now)

    def _put(self, orders: pd.DataFrame, parts: int) -> int:
        """Add orders to the buffer's parts; how many parts there are then."""
        for k in range(0, len(orders), PART_ROWS):
            self.parts.updateValue((parts,), (_packed(orders.iloc[k : k + PART_ROWS]),))
            parts += 1
        return parts

    def _taken(self, key, release: int, parts: int) -> Iterator[pd.DataFrame]:
        """All that waits, part by part; the buffer is empty then."""
        for k in range(parts):
            yield self._out(key, _unpacked(self.parts.getValue((k,))[0]), release)
            self.parts.removeKey((k,))

    def _due(self, now: int, since: int) -> bool:
        aged = self.limits.seconds is not None and now - since >= self.limits.seconds * 1000
        return aged or (self.cutoff is not None and (self.clock >= self.cutoff if self.clock else past_clock(now, self.cutoff)))

    def _numbers(self, came: pd.DataFrame, waiting: Waiting, due: bool, now: int, since: int) -> tuple[np.ndarray, Waiting]:
        """Release of each new order, and the open group after them, if thresholds are tested after every order."""
        weights, volumes = _millionths(came["total_weight"]), _millionths(came["total_volume"])
        if due and self._due(now, now):  # after the cut-off every order goes out alone
            return waiting.number + np.arange(len(came)), Waiting(waiting.number + len(came))
        if due:  # too old: the first order goes out with those that waited
            rest = came.iloc[1:]
            numbers, left = self._numbers(rest, Waiting(waiting.number + 1, 0, 0, 0), False, now, now) if len(rest) else (np.zeros(0, dtype=np.int64), Waiting(waiting.number + 1))
            return np.concatenate(([waiting.number], numbers)), left
        return Orders(weights, volumes, np.zeros(len(came), dtype=np.int64), self.whole).numbers(waiting)

    def _keep(self, left: Waiting, since: int, waiting: int, parts: int, now: int) -> None:
        self.totals.update((int(left.number), int(left.weight), int(left.volume), int(since), int(waiting), int(parts)))
        if not self.timed:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if waiting and self.limits.seconds is not None:
            self.handle.registerTimer(max(now + 1, int(since + self.limits.seconds * 1000)))
        elif waiting and self.cutoff is not None:
            self.handle.registerTimer(now + _LOOK_MS)

    def _out(self, key, orders: pd.DataFrame, numbers: np.ndarray | int) -> pd.DataFrame:
        out = orders.reset_index(drop=True)
        out.insert(0, "release", numbers)
        out.insert(0, "lane", key[1])
        out.insert(0, "key", key[0])
        out["status"] = READY_FOR_DISPATCH
        return out

    def close(self) -> None:
        pass


def threshold_stream(
    orders: DataFrame,
    key: str = "depot",
    limits: Limits = FLUSH_LIMITS,
    per_order: bool = True,
    cutoff: str | None = None,
    lanes: int = 1,
    clock: str | None = None,
) -> DataFrame:
    """Released orders with the number of their release.

    Thresholds are tested after every order, or with ``per_order=False`` once per micro-batch.
    Age is wall-clock time since the last release; ``cutoff`` releases everything from that time of
    day on. A busy key gets several independent buffers with ``lanes``, as several readers of a
    partitioned log would have.
    """
    digits = F.conv(F.substring(F.md5(F.coalesce("order_id", F.lit(""))), 1, 4), 16, 10).cast("int")
    lane = F.pmod(digits, F.lit(lanes)).cast("int")
    rows = orders.select(F.col(key).cast("string").alias("key"), lane.alias("lane"), *_COLUMNS)
    buffer = Buffer(limits, per_order, cutoff, clock)
    return rows.groupBy("key", "lane").transformWithStateInPandas(buffer, RELEASED, "append", "ProcessingTime" if buffer.timed else "None")


def totals_by_release(released: DataFrame, keys: Sequence[str] = ("key", "lane", "release")) -> DataFrame:
    return released.groupBy(*keys).agg(
        F.count("*").alias("orders"), F.sum("total_weight").alias("weight"), F.sum("total_volume").alias("volume")
    )

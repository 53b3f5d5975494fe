"""Order streams. The transforms are those of the batch jobs; only source, sink and trigger differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow import config
from parcelflow.operators import orders, packing
from parcelflow.session import ROCKSDB, STATE_STORE
from parcelflow.sources.sinks import keyed_records


def start(
    stream: DataFrame,
    path: str | None,
    checkpoint: str,
    by: Sequence[str] = (),
    fmt: str = "parquet",
    every: str | None = None,
    timers: bool = False,
    buffers: bool = False,
    **options: str,
) -> StreamingQuery:
    """Append a stream to a table.

    Without ``every`` it takes all that is there and stops by itself; ``every="5 minutes"`` keeps it running.
    A stream with processing-time ``timers`` always has another empty batch to run, so to stop by
    itself it must run batches for data only. A stream with ``buffers`` of its own, several values and lists
    per key, needs a state store that can hold them, whatever the session's is.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**options)
    if by:
        writer = writer.partitionBy(*by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    conf, own = stream.sparkSession.conf, {}  # a stream keeps the settings it was started with
    if timers and not every:
        own["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    if buffers:
        own[STATE_STORE] = ROCKSDB
    before = {name: conf.get(name) for name in own}
    try:
        for name, value in own.items():
            conf.set(name, value)
        return writer.start(path) if path else writer.start()
    finally:
        for name, value in before.items():
            conf.set(name, value)


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for the end of a stream, or stop it after some time between two micro-batches."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()


def silver_stream(
    events: DataFrame, depots: Sequence[config.Depot] = config.DEPOTS, delay: str = "30 seconds"
) -> DataFrame:
    """Events to silver orders. Nothing is late here: a watermark only acts on operators with state."""
    return orders.silver_orders(events, depots).withWatermark("order_timestamp", delay)


def gold_stream(silver: DataFrame) -> DataFrame:
    return orders.gold_orders(silver)


def ready_stream(gold: DataFrame) -> DataFrame:
    return orders.ready_orders(gold)


def hourly_status_stream(bronze: DataFrame, delay: str = "15 minutes") -> DataFrame:
    return orders.by_hour_label(bronze.withWatermark("order_timestamp", delay))


def tumbling_stream(
    bronze: DataFrame, length: str = "2 minutes", delay: str = "1 minute", at: str = "order_timestamp"
) -> DataFrame:
    """Window totals, written once the watermark closes a window; later orders for it are dropped and counted."""
    totals = packing.tumbling_totals(bronze.withWatermark(at, delay), length, at)
    return totals.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total_weight", "total_volume"
    )


def window_totals_stream(
    bronze: DataFrame, length: str = "10 minutes", delay: str = "1 minute", at: str = "order_timestamp"
) -> DataFrame:
    """True totals of every closed window, one row each."""
    return (
        bronze.withWatermark(at, delay)
        .groupBy(F.window(at, length))
        .agg(
            F.sum("total_volume").alias("accumulated_volume"),
            F.sum("total_weight").alias("accumulated_weight"),
            F.count("*").alias("window_orders"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "accumulated_volume", "accumulated_weight", "window_orders")
    )


def window_member_stream(bronze: DataFrame, length: str = "10 minutes", at: str = "order_timestamp") -> DataFrame:
    """Orders with the start of their window; without state, so a busy window is no more work than others."""
    columns = ("order_id", "customer_id", "total_weight", "total_volume", "total_price", "lat", "lon", at)
    return bronze.select(F.window(at, length)["start"].alias("window_start"), *columns)


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late, over the progress reports that Spark still holds."""
    return sum(
        int(state["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def publish(orders_: DataFrame, key: str = "customer_id") -> DataFrame:
    """Orders as keyed JSON records for a log sink such as Kafka or Kinesis."""
    return keyed_records(orders_, key)

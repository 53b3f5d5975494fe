"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the given tables, BENCH_CPUS the number of local cores.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelflow.plans.registry import QUERIES, prepare  # noqa: E402
from parcelflow.session import build_session  # noqa: E402

HEADLINES = (
    "flatten_events",
    "gold_paid_orders",
    "nearest_depot",
    "fifo_capacity_batches",
    "batch_totals",
    "tumbling_totals",
    "window_threshold_clamp",
    "threshold_flush_batches",
    "lorry_split",
    "batch_visits",
    "request_documents",
    "solution_load",
    "report_table",
    "driver_stops",
    "stops_with_totals",
    "driver_totals",
    "driver_performance",
    "top_stops_per_driver",
    "mark_dispatched",
    "stream_gold_orders",
    "stream_tumbling_totals",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES
    prepare(spark, folder)  # inputs of the operators, before the clock starts
    QUERIES["batch_totals"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in chosen:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()

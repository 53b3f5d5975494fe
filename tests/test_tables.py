"""Sources, sinks, jobs and plans."""

import json
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelflow import config, schemas
from parcelflow.operators import packing, requests, solutions
from parcelflow.plans import jobs, reports, views
from parcelflow.session import STATE_STORE
from parcelflow.sources import files, sinks, tables, testdata
from parcelflow.streaming import flush, jobs as streams
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "orders")
    testdata.paid_orders(spark, SMALL).write.parquet(path)
    return path


def test_scan_is_pruned(spark):
    text = plan(testdata.paid_orders(spark, SMALL).select("order_id", "total_weight"))
    assert "collect" not in text and "l_extendedprice" not in text and "o_totalprice" not in text


def test_filters_reach_the_files(spark, tmp_path, gold):
    rows = tables.read_table(spark, gold)
    assert "PushedFilters: [IsNotNull(depot), EqualTo(depot,Vallecas)]" in plan(rows.filter("depot = 'Vallecas'"))
    sinks.append(rows.withColumn("label", F.date_format("month", "yyyy-MM")), f"{tmp_path}/by", ["label"])
    text = plan(tables.read_table(spark, f"{tmp_path}/by").filter("label = '1996-05'"))
    assert "PartitionFilters: [isnotnull(label" in text


def test_top_stops_are_cut_before_the_shuffle(spark):
    table = solutions.with_dispatch_times(testdata.solutions(spark, SMALL))
    text = plan(reports.top_stops_per_driver(solutions.driver_stops(table)))
    assert text.count("WindowGroupLimit") == 2


def test_pack_and_request_jobs_can_run_again(spark, tmp_path, gold):
    ready, packed, wanted = (f"{tmp_path}/{name}" for name in ("ready", "packed", "wanted"))
    rows = tables.read_table(spark, gold).drop("month").withColumn("hour", F.date_trunc("month", "hour"))
    sinks.append(rows.withColumn("status", F.lit(config.READY)), ready, ["hour"])
    sinks.append(rows.withColumn("status", F.lit(config.READY)).limit(50), ready, ["hour"])  # copies stay
    for _ in range(2):
        jobs.pack_orders(spark, ready, packed)
    result = tables.read_table(spark, packed)
    assert result.count() == rows.count() + 50
    assert set(result.columns) == {*rows.columns, "batch_id"}
    jobs.request_batches(spark, packed, wanted)
    documents = tables.read_table(spark, wanted)
    assert documents.count() == result.select("hour", "batch_id").distinct().count()
    document = json.loads(documents.first()["document"])
    assert set(document) == {"visits", "fleet", "options"} and document["options"] == config.ROUTING_OPTIONS
    assert document["fleet"] == requests.fleet_plan()
    visit = next(iter(document["visits"].values()))
    assert set(visit) == {"location", "start", "end", "duration"} and visit["duration"] == 5


def test_fleet_forms(spark):
    rows = {r.driver_id: r.depot_id for r in requests.fleet_table(spark).collect()}
    assert len(rows) == 18
    assert [rows[f"driver_{n}"] for n in (1, 6, 7, 12, 13, 18)] == [f"depot_{n}" for n in (1, 1, 2, 2, 3, 3)]
    last = {r.depot_id for r in requests.fleet_table(spark, last_depot=True).collect()}
    assert last == {"depot_3"}
    crowded = config.Settings(fleet=config.Fleet(drivers=30))
    assert len(requests.fleet_plan(crowded)) == 18  # three depots of six drivers
    ruled = requests.fleet_plan(config.Settings(driver_rules=config.DRIVER_RULES))["driver_18"]
    assert ruled["strict_start"] and [pause["id"] for pause in ruled["breaks"]] == ["lunch", "client call"]


def test_usual_values_fill_gaps_of_a_visit(spark):
    row = spark.sql("""SELECT 'o1' order_id, string(null) customer_id, 40.12345678d lat, -3.123456789d lon,
                       double(null) total_weight, 2.1d total_volume, '10:00' start, int(null) duration""")
    visit = requests.loaded_visit_column(start=F.col("start"), duration=F.col("duration"))
    got = row.select(visit.alias("v")).first().v.asDict(recursive=True)
    assert got.pop("priority") in config.PRIORITIES
    assert got == {
        "location": {"name": "Unknown", "lat": 40.123457, "lng": -3.1234568},
        "start": "10:00",
        "end": "18:00",
        "duration": 5,
        "load": {"weight": 10, "volume": 3},
    }


def test_a_batch_is_one_request_at_any_size(spark):
    rows = spark.range(20_000).select(
        F.lit(1).alias("batch_id"),
        F.when(F.col("id") > 0, F.concat(F.lit("o"), F.col("id"))).alias("order_id"),
        F.concat(F.lit("c"), F.col("id")).alias("customer_id"),
        F.lit(40.0).alias("lat"),
        F.lit(-3.0).alias("lon"),
        F.timestamp_seconds(F.col("id")).alias("order_timestamp"),
    )
    (document,) = requests.request_documents(rows, ["batch_id"]).collect()
    visits = json.loads(document.document)["visits"]
    assert document.visits == len(visits) == 20_000 and any(key.startswith("no-id-c0") for key in visits)
    moved = rows.withColumn("lat", F.lit(41.0)).withColumn("order_timestamp", F.col("order_timestamp") - F.expr("INTERVAL 1 DAY"))
    twice = requests.batch_visits(rows.unionByName(moved.filter("order_id is not null")), ["batch_id"])
    (seen,) = twice.select(F.size("visits").alias("n"), F.col("visits")["o5"]["location"]["lat"].alias("lat")).collect()
    assert (seen.n, seen.lat) == (20_000, 40.0)


ANSWER = {
    "id": "run-1",
    "finished_at": "2024-10-05T18:14:00Z",
    "timing": {"finishedProcessingAt": None},
    "output": {
        "unserved": None,
        "num_late_visits": 1,
        "total_distance": 9.0,
        "distances": {"driver_1": 4.0, "driver_19": 5.0},
        "vehicle_overtime": {"driver_1": 2},
        "solution": {
            "driver_1": [
                {"location_id": "depot_1", "location_name": "Vallecas", "arrival_time": "09:00", "distance": 0.0},
                {"location_id": "ord-1", "location_name": "cus-1", "finish_time": "10:00", "distance": 4.0},
                {"location_id": "ord-2", "location_name": "cus-1", "finish_time": "9:30", "distance": 4.0},
                {"location_id": "ord-3", "location_name": "cus-2", "finish_time": "soon", "distance": 4.0},
            ],
            "driver_2": [],
            "driver_3": None,
        },
        "polylines": {"driver_1": ["abc"]},
    },
}


@pytest.fixture()
def answers(spark, tmp_path):
    for number, changes in enumerate([{}, {"id": "run-2"}]):  # two runs with one finish time
        (tmp_path / "answers").mkdir(exist_ok=True)
        (tmp_path / "answers" / f"{number}.json").write_text(json.dumps({**ANSWER, **changes}, indent=4))
    jobs.load_solutions(spark, f"{tmp_path}/answers", f"{tmp_path}/table")
    return tables.read_table(spark, f"{tmp_path}/table")


def test_multi_line_answers(spark, tmp_path, answers):
    assert answers.count() == 2 and {r.dispatched_hour for r in answers.collect()} == {"UNKNOWN"}
    jobs.load_solutions(spark, f"{tmp_path}/answers", f"{tmp_path}/table")
    assert tables.read_table(spark, f"{tmp_path}/table").count() == 2  # its hours are replaced
    assert files.read_documents(spark, f"{tmp_path}/answers").schema["output"].dataType["polylines"] is not None


def test_reports_on_answers(spark, answers):
    stops = solutions.driver_stops(answers)
    assert stops.count() == 8  # empty and missing routes have no rows
    joined = reports.join_stops_to_runs(stops, solutions.run_summary(answers), config.driver_ids())
    carried = reports.stops_with_totals(answers).drop("id")
    assert joined.exceptAll(carried).isEmpty() and carried.exceptAll(joined).isEmpty()
    paired = reports.join_stops_to_runs(stops.drop("id"), solutions.run_summary(answers), config.driver_ids(), ["finished_at"])
    assert paired.count() == 16  # by finish time alone the two runs mix
    performance = {(r.id, r.driver_id): r.total_distance for r in reports.driver_performance(answers).collect()}
    assert len(performance) == 36 and performance["run-1", "driver_1"] == 4.0 and performance["run-1", "driver_2"] is None
    assert reports.unserved_runs(answers).isEmpty() and reports.late_runs(answers).count() == 2
    renamed = solutions.with_order_ids(answers).select(F.explode(F.col("output.solution")["driver_1"]).alias("s"))
    assert {(r.s.location_id, r.s.order_id) for r in renamed.collect()} == {
        ("depot_1", None), (None, "ord-1"), (None, "ord-2"), (None, "ord-3"),
    }


def test_served_orders_are_marked_with_the_latest_time(spark, answers):
    served = solutions.served_customers(answers, F.lit("2024-10-05").cast("date"))
    assert served.count() == 6
    at = datetime(2024, 10, 1)
    orders = spark.createDataFrame(
        [("a", "cus-1", "READY", at), ("b", "cus-9", "READY", at), ("c", None, "READY", at)],
        "order_id string, customer_id string, status string, order_timestamp timestamp",
    )
    rows = {r.order_id: r for r in solutions.mark_dispatched(orders, served).collect()}
    assert (rows["a"].status, rows["a"].order_timestamp) == ("DISPATCHED", datetime(2024, 10, 6, 10, 0))
    assert (rows["b"].status, rows["b"].order_timestamp) == ("READY", at) and rows["c"].status == "READY"
    assert [r.order_id for r in solutions.dispatched_orders(orders, served).collect()] == ["a"]


def test_dispatch_and_report_jobs(spark, tmp_path, answers):
    shape = "order_id string, customer_id string, status string, order_timestamp timestamp"
    rows = [("a", "cus-1", "READY", datetime(2024, 10, 1)), ("b", "cus-9", "READY", datetime(2024, 10, 1))]
    sinks.append(spark.createDataFrame(rows, shape), f"{tmp_path}/orders")
    day = F.lit("2024-10-05").cast("date")
    path = jobs.dispatch_served(spark, f"{tmp_path}/orders", answers, f"{tmp_path}/versions", day)
    assert {r.order_id: r.status for r in spark.read.parquet(path).collect()} == {"a": "DISPATCHED", "b": "READY"}
    assert tables.read_table(spark, f"{tmp_path}/orders").filter("status = 'READY'").count() == 2  # old version stays
    jobs.build_report_table(spark, f"{tmp_path}/table", f"{tmp_path}/report")
    report = tables.read_table(spark, f"{tmp_path}/report")
    assert report.count() == 2 and "output_polylines" not in report.columns and "output_solution" in report.columns


def test_views_and_catalog(spark, tmp_path, answers):
    sinks.overwrite(solutions.report_rows(answers), f"{tmp_path}/report", ["finished_at"])
    report = tables.read_table(spark, f"{tmp_path}/report", schema=solutions.report_rows(answers).schema)
    (run,) = views.run_views(report).collect()
    name = views.create_run_view(report, run.finished_at)
    assert name == run.view_name == "dispatched_orders_2024_10_05T18_14_00Z"
    assert views.query_view(spark, name).count() == 2
    assert "PartitionFilters: [isnotnull(finished_at" in views.query_view(spark, name)._jdf.queryExecution().toString()
    views.create_report_views(answers)
    assert views.query_view(spark, "driver_solutions").count() == 8
    full = jobs.catalog_report(spark, "reporting", "answers", f"{tmp_path}/report")
    assert tables.table_exists(spark, full) and spark.table(full).count() == 2
    with pytest.raises(ValueError):
        sinks.create_external_table(spark, full, report.schema, f"{tmp_path}/elsewhere", ["finished_at"])
    assert not tables.table_exists(spark, "reporting.nothing")
    assert tables.table_exists(spark, f"{tmp_path}/report") and not tables.table_exists(spark, f"{tmp_path}/none")


def test_sink_modes(spark, tmp_path):
    rows = spark.range(10).withColumn("part", F.col("id") % 2)
    path = f"{tmp_path}/t"
    sinks.overwrite(rows, path, ["part"])
    sinks.write_once(rows, path, ["part"])
    sinks.append(rows, path, ["part"])
    assert tables.read_table(spark, path).count() == 20
    sinks.overwrite_partitions(rows.filter("part = 0"), path, ["part"])
    assert tables.read_table(spark, path).count() == 15
    small = sinks.compacted(spark, path, f"{tmp_path}/small", files=1)
    assert tables.read_table(spark, small).count() == 15
    assert len(tables.read_table(spark, small).inputFiles()) == 1
    sinks.append(rows.withColumn("extra", F.lit(1)), f"{tmp_path}/wide")
    sinks.append(rows, f"{tmp_path}/wide")
    assert "extra" in tables.read_merged(spark, f"{tmp_path}/wide").columns


def test_job_folders(spark, tmp_path):
    rows = spark.createDataFrame([("j1", "{}"), ("j2", "{}"), ("j2", "{}")], "job_id string, document string")
    sinks.write_documents(rows, f"{tmp_path}/asked")
    sinks.write_documents(rows.filter("job_id = 'j1'"), f"{tmp_path}/done")
    asked, done = files.folder_jobs(spark, f"{tmp_path}/asked"), files.folder_jobs(spark, f"{tmp_path}/done")
    assert [r.job_id for r in files.pending_jobs(asked, done).collect()] == ["j2"]


def test_documents_take_little_disk(spark, tmp_path):
    text = "{" + ", ".join(f'"o{n}": {{"start": "9:00", "end": "18:30"}}' for n in range(2_000)) + "}"
    sinks.write_documents(spark.createDataFrame([("j1", text), ("j2", text)], "job_id string, document string"), f"{tmp_path}/asked")
    assert sum(file.stat().st_size for file in (tmp_path / "asked").rglob("part-*")) < len(text) // 2
    assert [r.value for r in spark.read.text(f"{tmp_path}/asked").select("value").collect()] == [text, text]


def test_payloads_take_little_disk_and_are_streamed(spark, tmp_path):
    events = spark.range(0, 3_000, 1, 2).selectExpr("concat('evt-', id) AS event_id", "named_struct('status', 'RECEIVED', 'country', 'Spain') AS order_details")
    sinks.write_payloads(events, f"{tmp_path}/events")
    plain = sum(len(json.dumps(r.asDict(recursive=True))) for r in events.collect())
    assert sum(file.stat().st_size for file in (tmp_path / "events").glob("part-*")) < plain // 2
    streamed = tables.read_json_events(spark, f"{tmp_path}/events", events.schema)
    streams.finish(streams.start(streamed, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    assert sorted(tables.read_table(spark, f"{tmp_path}/out").collect()) == sorted(events.collect())


def test_stream_equals_batch_over_several_micro_batches(spark, tmp_path, gold):
    """Orders come in time order, one file per micro-batch, so releases are those of the batch form."""
    from parcelflow.operators.flushing import threshold_groups

    paid = tables.read_table(spark, gold).drop("month")
    ordered = paid.orderBy("order_timestamp", "order_id")
    half = ordered.limit(paid.count() // 2)
    limits, source, path = config.Limits(700.0, 20_000.0), f"{tmp_path}/in", f"{tmp_path}/out"
    (tmp_path / "in").mkdir()
    released = flush.threshold_stream(tables.read_stream(spark, source, schemas.GOLD_ORDER), "depot", limits)
    for part in (half, paid.join(half.select("order_id"), "order_id", "left_anti").select(*paid.columns)):
        part.write.mode("append").parquet(source)
        streams.finish(streams.start(released, path, f"{tmp_path}/checkpoint"))
    got = {(r.key, r.order_id): r.release for r in tables.read_table(spark, path).collect()}
    want = {(r.depot, r.order_id): r.flush_id for r in threshold_groups(paid, limits=limits).collect()}
    still_open = {key: max(n for (k, _), n in want.items() if k == key) for key, _ in want}
    assert got == {key: n for key, n in want.items() if n < still_open[key[0]] or key in got}
    assert len(got) > 0.8 * len(want)


def test_cutoff_releases_at_once(spark, tmp_path, gold):
    stream = tables.read_stream(spark, gold, schemas.GOLD_ORDER, max_files=1)
    released = flush.threshold_stream(stream, limits=config.CUTOFF_LIMITS, per_order=False, cutoff="00:00", lanes=2)
    streams.finish(streams.start(released, f"{tmp_path}/out", f"{tmp_path}/checkpoint", timers=True))
    assert tables.read_table(spark, f"{tmp_path}/out").count() == tables.read_table(spark, gold).count()
    assert flush.past_clock(43_200_000, "12:00") and not flush.past_clock(43_140_000, "12:00")


class _Kept:
    """A state value or map in memory, which counts the rows that it is handed at once."""

    def __init__(self):
        self.value, self.parts = None, {}

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.parts[key] = value

    def getValue(self, key):
        return self.parts.get(key)

    def removeKey(self, key):
        del self.parts[key]


def _buffer(limits):
    buffer = flush.Buffer(limits, False, "12:00", "09:00")
    buffer.timed, buffer.totals, buffer.parts = False, _Kept(), _Kept()
    return buffer


def _arriving(first, rows, parts, seen):
    for k in range(parts):
        seen.append(k)
        number = range(first + k * rows, first + (k + 1) * rows)
        yield pd.DataFrame({"order_id": [f"o{n}" for n in number], "customer_id": None, "total_weight": [1.0, float("nan")] * (rows // 2), "total_volume": 0.0, "order_timestamp": pd.Timestamp("2024-10-01")})


@pytest.mark.parametrize("clock", ["09:00", "12:00"])
def test_a_buffer_is_held_and_released_in_parts(clock):
    """Orders are never brought together: each part that comes is put away, or goes out, before the next is asked for."""
    buffer, seen = _buffer(config.Limits(1e15, 1e15)), []
    assert list(buffer.handleInputRows(("Getafe", 0), _arriving(0, 100, 5, seen), None)) == []
    assert len(buffer.parts.parts) == 5 and buffer.totals.value[1] == 250 * 1_000_000 and buffer.totals.value[4:] == (500, 5)
    buffer.clock, buffer.limits = clock, config.Limits(501.0, 1e15)
    buffer.whole = flush.bounds(buffer.limits)
    seen.clear()
    out = buffer.handleInputRows(("Getafe", 0), _arriving(500, 100, 6, seen), None)
    first = next(out, None)
    if clock == "09:00":  # full, which only the last part tells: 250 + 300 of 501
        assert len(seen) == 6 and len(buffer.parts.parts) == 11
    else:
        assert len(seen) == 1 and len(buffer.parts.parts) == 5
    gone = [first, *out]
    assert len(gone) == 11 and max(map(len, gone)) == 100 and not buffer.parts.parts
    assert sorted(pd.concat(gone)["order_id"]) == sorted(f"o{n}" for n in range(1100)) and {n for part in gone for n in part["release"]} == {0}
    assert pd.concat(gone)["total_weight"].sum() == 550 and buffer.totals.value[:3] == (1, 0, 0) and buffer.totals.value[4:] == (0, 0)


@pytest.mark.parametrize("timers", [False, True])
def test_buffers_bring_their_state_store(spark, tmp_path, timers):
    """A session with Spark's own state store can run them, and keeps its settings."""
    rows = [(f"o{n}", "c", 1.0, 1.0, datetime(2024, 10, 1, 0, n), "Getafe") for n in range(5)]
    shape = "order_id string, customer_id string, total_weight double, total_volume double, order_timestamp timestamp, depot string"
    spark.createDataFrame(rows, shape).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = tables.read_stream(spark, f"{tmp_path}/in", shape)
    released = flush.threshold_stream(stream, "depot", config.Limits(2.0, 1e9), not timers, "12:00" if timers else None, clock="13:00")
    before, usual = spark.conf.get(STATE_STORE), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    try:
        spark.conf.set(STATE_STORE, usual)
        streams.finish(streams.start(released, f"{tmp_path}/out", f"{tmp_path}/checkpoint", timers=timers, buffers=True))
        assert spark.conf.get(STATE_STORE) == usual
    finally:
        spark.conf.set(STATE_STORE, before)
    got = {r.order_id: r.release for r in tables.read_table(spark, f"{tmp_path}/out").collect()}
    assert got == ({f"o{n}": 0 for n in range(5)} if timers else {"o0": 0, "o1": 0, "o2": 1, "o3": 1})


def test_late_orders_are_dropped_and_counted(spark, tmp_path):
    def write(*minutes):
        rows = [(datetime(2024, 10, 1, 0, m), 1.0, 2.0) for m in minutes]
        shape = "order_timestamp timestamp, total_weight double, total_volume double"
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    write(0, 1, 10)
    shape = "order_timestamp timestamp, total_weight double, total_volume double"
    stream = streams.tumbling_stream(tables.read_stream(spark, f"{tmp_path}/in", shape))
    late = 0
    for minutes in ((), (0, 20), ()):
        if minutes:
            write(*minutes)
        query = streams.start(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        streams.finish(query)
        late += streams.late_rows(query)
    rows = tables.read_table(spark, f"{tmp_path}/out").orderBy("window_start").collect()
    assert [(r.window_start.minute, r.total_weight) for r in rows] == [(0, 2.0), (10, 1.0)]
    assert late == 1


def test_archived_inputs_and_publishing(spark, tmp_path):
    spark.range(3).withColumn("customer_id", F.lit("cus-1")).write.parquet(f"{tmp_path}/in")
    stream = tables.read_stream(spark, f"{tmp_path}/in", "id bigint, customer_id string")
    streams.finish(streams.start(streams.publish(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint", fmt="json"))
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert {(r.key, json.loads(r.value)["id"]) for r in rows} == {("cus-1", n) for n in range(3)}


def test_inputs_are_archived(spark, tmp_path):
    stream = None
    for number in range(3):
        spark.range(number, number + 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = tables.read_archiving_stream(spark, f"{tmp_path}/in", "id bigint", f"{tmp_path}/archive")
        streams.finish(streams.start(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    assert {r.id for r in tables.read_table(spark, f"{tmp_path}/out").collect()} == {0, 1, 2}
    assert any(tmp_path.glob("archive/**/*.parquet"))


def test_start_position_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_stream_from(spark, str(tmp_path), "id bigint", "middle")


def test_temporary_tables_go(spark):
    import os

    from parcelflow.session import scratch_path, stored, temporary

    kept = scratch_path(spark, "kept")
    with temporary(spark):
        inner = scratch_path(spark, "inner")
        spark.range(3).write.parquet(inner)
        stored(spark.range(5), "inside").write.parquet(kept)
    assert not os.path.exists(inner) and spark.read.parquet(kept).count() == 5


def test_a_timed_stream_writes_hours_and_stops(spark, tmp_path, gold):
    import os

    stream = streams.hourly_status_stream(tables.read_stream(spark, gold, schemas.GOLD_ORDER).where("crc32(order_id) % 40 = 0"))
    running = streams.start(stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", by=["order_hour"], every="1 second")
    running.processAllAvailable()
    streams.finish(running, 2)
    assert not running.isActive
    want = {r.order_hour for r in streams.hourly_status_stream(tables.read_table(spark, gold).where("crc32(order_id) % 40 = 0")).select("order_hour").distinct().collect()}
    assert want and {name.split("=")[1] for name in os.listdir(f"{tmp_path}/hours") if "=" in name} == want

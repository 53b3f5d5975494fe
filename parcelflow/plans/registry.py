"""Every operator as a query over the given tables.

Times leave as text, counts as bigint, so that any SQL engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config, schemas
from parcelflow.config import Limits
from parcelflow.functions import geo, text, times
from parcelflow.operators import flushing, lorries, nearest, orders, packing, requests, solutions
from parcelflow.operators.flatten import drop_fields, typed_location
from parcelflow.plans import exports, jobs, reports, views
from parcelflow.session import scratch_path, stored
from parcelflow.sources import files, sinks, tables, testdata
from parcelflow.streaming import flush, jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Limits under which the sparse given orders form groups of several orders.
PERIOD = "month"
FLUSH = Limits(weight=700.0, volume=20_000.0, seconds=864_000.0)
WEEK = "7 days"
AS_OF = "2024-10-05"
SHOWN_DRIVER = "driver_3"
SHOWN_ROWS = 100


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def stamp(at: Column | str) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def number(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def on_day(value: str) -> Column:
    return F.col(value).cast("string").alias(value)


# --- cleaning -----------------------------------------------------------------------------------


@query
def flatten_events(spark, folder):
    silver = orders.silver_orders(testdata.order_events(spark, folder))
    items = F.col("order_details_items")
    return silver.select(
        "event_id",
        "event_timestamp",
        "order_id",
        "order_details_customer_id",
        "order_details_order_date",
        "order_details_total_amount",
        "order_details_total_volume",
        "order_details_total_weight",
        "order_details_destination_address_house_number",
        "order_details_destination_address_country",
        "order_details_payment_details_payment_status",
        "order_details_payment_details_transaction_id",
        "lat",
        "lon",
        "depot",
        stamp("order_timestamp").alias("order_timestamp"),
        number(F.size(items)).alias("items"),
        F.aggregate(items, F.lit(0), lambda so_far, item: so_far + item["quantity"]).cast("bigint").alias("quantity"),
        number(F.size(F.flatten(items["packages"]))).alias("packages"),
    )


@query
def parsed_order_times(spark, folder):
    events = testdata.order_events(spark, folder).select("order_id", "event_timestamp")
    at = times.parsed(F.col("event_timestamp"))
    return events.select(
        "order_id",
        stamp(at).alias("parsed_at"),
        stamp(F.col("event_timestamp").try_cast("timestamp")).alias("at_by_cast"),
        stamp(times.hour_start(at)).alias("hour"),
        times.hour_label(at).alias("hour_label"),
        times.file_label(at).alias("file_label"),
        times.day(at).cast("string").alias("day"),
        times.next_day(at).cast("string").alias("next_day"),
    )


def _gold_columns(gold: DataFrame) -> DataFrame:
    return gold.select(
        "order_id",
        "customer_id",
        "total_weight",
        "total_volume",
        "total_price",
        stamp("order_timestamp").alias("order_timestamp"),
        "status",
        "lat",
        "lon",
        "depot",
        stamp("hour").alias("hour"),
    )


@query
def gold_paid_orders(spark, folder):
    return _gold_columns(testdata.paid_orders(spark, folder))


@query
def nearest_depot(spark, folder):
    rows = testdata.flat_orders(spark, folder)
    lat, lon = F.col("lat"), F.col("lon")
    return rows.select(
        "order_id",
        geo.nearest_depot(lat, lon).alias("depot"),
        F.least(*[geo.manhattan(lat, lon, depot) for depot in config.DEPOTS]).alias("distance"),
    )


def _many_depots(spark: SparkSession, folder: str) -> DataFrame:
    """A depot at every customer: a third in one town, the others over the country; many share a place."""
    customer = testdata.table(spark, folder, "customer")
    lat = F.expr("(403121 + (c_custkey * 3571) % if(c_custkey % 3 = 0, 40, 3400)) / 10000D")
    lng = F.expr("(-38666 + (c_custkey * 8461) % if(c_custkey % 3 = 0, 40, 2993)) / 10000D")
    return customer.select(F.concat(F.lit("site-"), F.col("c_custkey").cast("string")).alias("name"), F.col("c_custkey").alias("place"), lat.alias("lat"), lng.alias("lng"))


@query
def nearest_depot_of_table(spark, folder):
    rows = testdata.flat_orders(spark, folder).select("order_id", "lat", "lon")
    return nearest.with_nearest(rows, _many_depots(spark, folder)).select("order_id", "depot", "distance")


def _mixed_statuses(spark: SparkSession, folder: str) -> DataFrame:
    states = (config.RECEIVED, config.IN_PROGRESS, config.READY_FOR_DISPATCH, config.DISPATCHED)
    key = F.regexp_extract("order_id", r"(\d+)$", 1).cast("bigint")
    status = F.array(*[F.lit(state) for state in states])[F.pmod(key, F.lit(len(states))).cast("int")]
    return testdata.flat_orders(spark, folder).withColumn("status", status)


@query
def status_transition(spark, folder):
    rows = _mixed_statuses(spark, folder)
    return orders.by_hour_label(rows).select(
        "order_id", "status", "order_hour", F.lit(config.READY).alias("status_for_packing")
    )


@query
def status_counts(spark, folder):
    """All choices from one count by status: the orders are read once."""
    counted = _mixed_statuses(spark, folder).groupBy("status").agg(F.count("*").alias("orders"))
    chosen = F.array_compact(
        F.array(
            F.when(F.col("status") == config.IN_PROGRESS, "new"),
            F.when(F.col("status") == config.READY_FOR_DISPATCH, "ready"),
            F.when(F.col("status").isin(*reports.SHOWN_STATUSES), "shown"),
        )
    )
    return counted.select(F.explode(chosen).alias("choice"), "status", "orders")


# --- packing ------------------------------------------------------------------------------------


#: Input tables made beforehand, by name and folder; the bench fills it, so that it times operators and not their inputs.
PREPARED: dict[tuple[str, str], DataFrame] = {}


def _prepared(name: str, folder: str) -> DataFrame | None:
    return PREPARED.get((name, folder))


def prepare(spark: SparkSession, folder: str) -> None:
    """Make the orders, the packed orders and the answers once."""
    PREPARED["gold", folder] = _gold(spark, folder)
    PREPARED["packed", folder] = _packed(spark, folder)
    PREPARED["answers", folder] = stored(testdata.solutions(spark, folder), "answers")


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    """Gold orders as the table that the packing jobs read, some of them more than once."""
    return _prepared("gold", folder) or stored(testdata.paid_orders(spark, folder), "gold")


def _batches(spark: SparkSession, folder: str) -> DataFrame:
    return packing.capacity_batches(_gold(spark, folder), PERIOD)


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    """Packed orders as the table that the request job reads."""
    return _prepared("packed", folder) or stored(_batches(spark, folder), "packed")


@query
def fifo_capacity_batches(spark, folder):
    return _batches(spark, folder).select("order_id", stamp(PERIOD).alias(PERIOD), "status", "batch_id")


@query
def batch_totals(spark, folder):
    totals = packing.batch_totals(_batches(spark, folder), [PERIOD])
    return totals.select(
        stamp(PERIOD).alias(PERIOD),
        "batch_id",
        "orders",
        "total_weight",
        "total_volume",
        stamp("first_order").alias("first_order"),
        stamp("last_order").alias("last_order"),
    )


@query
def tumbling_totals(spark, folder):
    totals = packing.tumbling_totals(testdata.flat_orders(spark, folder))
    return totals.select(stamp("window.start").alias("window_start"), "total_weight", "total_volume")


@query
def window_threshold_clamp(spark, folder):
    rows = packing.dispatchable_windows(testdata.flat_orders(spark, folder), WEEK)
    return rows.select(
        stamp("window.start").alias("window_start"),
        "accumulated_volume",
        "accumulated_weight",
        "orders",
        "ready_volume",
        "ready_weight",
        "status",
    )


@query
def window_order_lists(spark, folder):
    rows = packing.window_members(testdata.flat_orders(spark, folder), WEEK)
    return rows.select(
        stamp("window_start").alias("window_start"),
        "order_id",
        "total_weight",
        "accumulated_volume",
        "accumulated_weight",
        "window_orders",
    )


@query
def window_dispatch_members(spark, folder):
    """Orders of the windows above both floors, with the window's load clamped to a lorry."""
    rows = packing.dispatchable_members(testdata.flat_orders(spark, folder), WEEK)
    return rows.select(stamp("window_start").alias("window_start"), "order_id", "ready_volume", "ready_weight", "status")


def _fractional(rows: DataFrame) -> DataFrame:
    """Orders with loads of one decimal, as the reference's domain has them."""
    return rows.withColumns({"total_weight": F.col("total_weight") / 10, "total_volume": F.col("total_volume") / 10})


@query
def fractional_capacity_batches(spark, folder):
    packed = packing.capacity_batches(_fractional(_gold(spark, folder)), PERIOD, Limits(100.0, 5000.0), slices=7)
    return packed.select("order_id", stamp(PERIOD).alias(PERIOD), "batch_id")


@query
def threshold_flush_batches(spark, folder):
    groups = flushing.threshold_groups(_gold(spark, folder), ["depot"], FLUSH)
    return groups.select("order_id", "depot", "flush_id", "status")


#: Groups of this size span several of the slices below.
LONG_FLUSH = Limits(weight=20_000.0, volume=600_000.0, seconds=80_000_000.0)


@query
def sliced_flush_batches(spark, folder):
    """Long groups over many slices, as a depot with most of the rows would have them."""
    groups = flushing.threshold_groups(_gold(spark, folder), ["depot"], LONG_FLUSH, slices=24)
    return groups.select("order_id", "depot", "flush_id")


@query
def lorry_split(spark, folder):
    split = lorries.lorry_split(lorries.lorry_loads(_gold(spark, folder), WEEK))
    return split.select("order_id", stamp("window_start").alias("window_start"), "status")


@query
def lorry_lists(spark, folder):
    split = lorries.lorry_split(lorries.lorry_loads(_gold(spark, folder), WEEK))
    return lorries.lorry_totals(split).select(
        stamp("window_start").alias("window_start"), "status", "orders", "total_volume", "total_weight"
    )


# --- requests -----------------------------------------------------------------------------------


@query
def fleet_assignment(spark, folder):
    rows = requests.depot_fleet(testdata.paid_orders(spark, folder), requests.fleet_table(spark))
    return rows.withColumn("min_visits", number("min_visits"))


def _exploded_visits(spark: SparkSession, folder: str, visit: Column) -> DataFrame:
    visits = requests.batch_visits(_packed(spark, folder), [PERIOD, "batch_id"], visit)
    return visits.select(
        stamp(PERIOD).alias(PERIOD), "batch_id", F.explode("visits").alias("order_id", "v")
    )


@query
def batch_visits(spark, folder):
    return _exploded_visits(spark, folder, requests.visit_column()).select(
        PERIOD,
        "batch_id",
        "order_id",
        "v.location.name",
        "v.location.lat",
        "v.location.lng",
        F.col("v.start").alias("start_time"),
        F.col("v.end").alias("end_time"),
        number("v.duration").alias("duration"),
    )


@query
def batch_visit_loads(spark, folder):
    return _exploded_visits(spark, folder, requests.loaded_visit_column()).select(
        PERIOD,
        "batch_id",
        "order_id",
        "v.location.name",
        "v.location.lat",
        "v.location.lng",
        F.col("v.start").alias("start_time"),
        number("v.load.weight").alias("weight"),
        number("v.load.volume").alias("volume"),
        "v.priority",
    )


@query
def request_documents(spark, folder):
    """Documents parsed back from their text."""
    path = scratch_path(spark, "requests")
    sinks.overwrite(requests.request_documents(_packed(spark, folder), [PERIOD, "batch_id"]), path)
    shape = (
        "visits map<string, struct<duration: int>>,"
        " fleet map<string, struct<start_location: struct<id: string>>>,"
        " options struct<traffic: string, balance: boolean>"
    )
    parsed = tables.read_table(spark, path).withColumn("request", F.from_json("document", shape))
    return parsed.select(
        stamp(PERIOD).alias(PERIOD),
        "batch_id",
        number(F.size("request.visits")).alias("visits"),
        number(F.size("request.fleet")).alias("drivers"),
        F.col("request.fleet")["driver_7"]["start_location"]["id"].alias("depot_of_driver_7"),
        F.col("request.options.traffic").alias("traffic"),
        F.col("request.options.balance").alias("balance"),
    )


@query
def pending_jobs(spark, folder):
    """Jobs are the packed months; every third one has no answer yet."""
    root = scratch_path(spark, "jobs")
    job = F.date_format(PERIOD, "yyyy-MM")
    documents = requests.request_documents(_packed(spark, folder), [PERIOD, "batch_id"])
    jobs_ = stored(documents.select(job.alias("job_id"), "document"), "job-documents")
    answered = F.pmod(F.substring("job_id", 6, 2).cast("int"), F.lit(3)) != 0
    sinks.write_documents(jobs_, f"{root}/batching")
    sinks.write_documents(jobs_.filter(answered), f"{root}/optimized")
    waiting = files.pending_jobs(
        files.folder_jobs(spark, f"{root}/batching"), files.folder_jobs(spark, f"{root}/optimized")
    )
    return waiting


# --- solutions ----------------------------------------------------------------------------------


def _raw_answers(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared("answers", folder) or testdata.solutions(spark, folder)


def _solutions(spark: SparkSession, folder: str) -> DataFrame:
    return solutions.with_dispatch_times(_raw_answers(spark, folder))


def _answers(spark: SparkSession, folder: str) -> str:
    """Answer documents, one per line."""
    path = scratch_path(spark, "answers")
    sinks.append_json_lines(_raw_answers(spark, folder), path)
    return path


def _loaded(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "solutions")
    jobs.load_solutions(spark, _answers(spark, folder), path, multi_line=False)
    return path


@query
def solution_load(spark, folder):
    return _solution_columns(tables.read_table(spark, _loaded(spark, folder)))


def _solution_columns(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        "id",
        "finished_at",
        F.col("dispatched_hour").cast("string").alias("dispatched_hour"),
        on_day("dispatched_date"),
        "output.num_late_visits",
        "output.num_unserved",
        "output.total_distance",
        number(F.size("output.solution")).alias("drivers"),
    )


def _reloads(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Three loads that overlap: the second has corrected answers of another time, the third repeats the first."""
    answers = stored(_raw_answers(spark, folder), "answers")
    run = F.substring_index("id", "-", -1).cast("bigint")
    later = F.date_format(times.parsed_iso(F.col("finished_at")) + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    corrected = {"region": F.lit("corrected"), "finished_at": later, "timing": F.struct(F.lit(None).cast("string").alias("finishedProcessingAt"))}
    wrong = run % 4 == 1
    first, second = answers.filter(run % 3 != 2), answers.filter(run % 3 != 0)
    second = second.withColumns({name: F.when(wrong, value).otherwise(F.col(name)) for name, value in corrected.items()})
    return [first, second, first]


@query
def solution_reloads(spark, folder):
    """Answers after all loads: every run once, corrected ones in their new half hour."""
    root = scratch_path(spark, "reloads")
    for number_, answers in enumerate(_reloads(spark, folder)):
        sinks.append_json_lines(answers, f"{root}/answers-{number_}")
        jobs.load_solutions(spark, f"{root}/answers-{number_}", f"{root}/solutions", multi_line=False)
    loaded = tables.read_table(spark, f"{root}/solutions", schema=solutions.with_dispatch_times(answers).schema)
    return _solution_columns(loaded).join(loaded.select("id", "region"), "id")


@query
def solution_reloads_by_date(spark, folder):
    root = scratch_path(spark, "reloads")
    for answers in _reloads(spark, folder):
        jobs.load_by_date(spark, answers, f"{root}/bronze", f"{root}/silver", f"{root}/lines")
    stored_under = tables.read_table(spark, f"{root}/bronze").select("id", F.col("dispatched_date").cast("string").alias("bronze_date"))
    drawn = tables.read_table(spark, f"{root}/lines").select("id", F.col("finished_at_clean").cast("string").alias("drawn_at"))
    silver = tables.read_table(spark, f"{root}/silver").join(stored_under, "id").join(drawn, "id")
    return silver.select("id", "region", "finished_at", "finished_at_clean", on_day("dispatched_date"), "bronze_date", "drawn_at")


@query
def multi_line_answers(spark, folder):
    """Answers as pretty JSON documents, one file each."""
    root = scratch_path(spark, "pretty")
    answers = _raw_answers(spark, folder)
    text_ = F.to_json(F.struct("*"), {"pretty": "true"})
    sinks.write_documents(answers.select(F.col("id").alias("job_id"), text_.alias("document")), f"{root}/answers")
    jobs.load_solutions(spark, f"{root}/answers", f"{root}/solutions")
    return _solution_columns(tables.read_table(spark, f"{root}/solutions"))


@query
def solution_tables_by_date(spark, folder):
    root = scratch_path(spark, "by-date")
    answers = files.read_documents(spark, _answers(spark, folder), schemas.SOLUTION, multi_line=False)
    jobs.load_by_date(spark, answers, f"{root}/bronze", f"{root}/silver", f"{root}/lines")
    bronze = tables.read_table(spark, f"{root}/bronze")
    silver = tables.read_table(spark, f"{root}/silver")
    stored_under = bronze.select("id", F.col("dispatched_date").cast("string").alias("bronze_date"))
    return silver.join(stored_under, "id").select(
        "id", "status", "finished_at", "input", "region", "finished_at_clean", on_day("dispatched_date"), "bronze_date"
    )


@query
def route_archive(spark, folder):
    path = scratch_path(spark, "archive")
    jobs.archive_routes(spark, _loaded(spark, folder), path)
    stops = F.aggregate(
        F.map_values("output.solution"), F.lit(0), lambda so_far, route: so_far + F.size(route)
    )
    return tables.read_table(spark, path).select(
        "input", F.col("dispatched_hour").cast("string").alias("dispatched_hour"), number(stops).alias("stops")
    )


@query
def route_polylines(spark, folder):
    path = scratch_path(spark, "lines")
    silver = solutions.same_day_partition(_raw_answers(spark, folder))
    sinks.overwrite(solutions.route_lines(silver), path, ["finished_at_clean"])
    lines = tables.read_table(spark, path).select(
        F.col("finished_at_clean").cast("string").alias("finished_at_clean"),
        F.explode("polylines").alias("driver_id", "line"),
    )
    return lines.select("finished_at_clean", "driver_id", number(F.size("line")).alias("points"))


def _report_table(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "report")
    sinks.overwrite(solutions.report_rows(_solutions(spark, folder)), path, ["finished_at"])
    return path


def _report_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("finished_at").cast("string").alias("finished_at"),
        "dispatched_hour",
        on_day("dispatched_date"),
        "output_status",
        "output_total_travel_time",
        "output_total_visit_lateness",
        "output_num_late_visits",
        "output_num_unserved",
        "output_total_distance",
        "output_unserved",
        number(F.size("output_distances")).alias("drivers"),
    )


@query
def report_table(spark, folder):
    return _report_columns(tables.read_table(spark, _report_table(spark, folder)))


@query
def trimmed_answers(spark, folder):
    trimmed = solutions.trimmed_output(_solutions(spark, folder))
    fields = F.lit(",".join(sorted(trimmed.schema["output"].dataType.names)))
    return trimmed.select("finished_at", on_day("dispatched_date"), fields.alias("fields"), "output.total_distance")


@query
def catalog_report_table(spark, folder):
    name = f"dispatched_orders_{uuid4().hex[:8]}"
    sinks.create_database(spark, "parcelflow_reports", scratch_path(spark, "database"))
    full = jobs.catalog_report(spark, "parcelflow_reports", name, _report_table(spark, folder))
    return _report_columns(spark.table(full))


@query
def views_by_run(spark, folder):
    table = tables.read_table(spark, _report_table(spark, folder))
    table = table.withColumn("finished_at", F.col("finished_at").cast("string"))
    return views.run_views(table)


@query
def latest_run_view(spark, folder):
    """The run that finished last, read through its view: only its folder is read."""
    table = tables.read_table(spark, _report_table(spark, folder))
    table = table.withColumn("finished_at", F.col("finished_at").cast("string"))
    last = table.agg(F.max("finished_at")).first()[0]
    return _report_columns(views.query_view(spark, views.create_run_view(table, last)))


# --- reports ------------------------------------------------------------------------------------


def _stops(spark: SparkSession, folder: str) -> DataFrame:
    return solutions.driver_stops(_solutions(spark, folder)).withColumn(
        "dispatched_date", F.col("dispatched_date").cast("string")
    )


@query
def driver_stops(spark, folder):
    return _stops(spark, folder)


@query
def run_summary_flat(spark, folder):
    views.create_report_views(_solutions(spark, folder))
    flat = views.query_view(spark, "dispatched_orders_flat")
    return flat.withColumn("dispatched_date", F.col("dispatched_date").cast("string"))


@query
def solution_key_rename(spark, folder):
    renamed = solutions.with_order_ids(_solutions(spark, folder))
    routes = renamed.select("id", F.explode("output.solution").alias("driver_id", "route"))
    stops = routes.select("id", "driver_id", F.explode("route").alias("stop"))
    return stops.select("id", "driver_id", "stop.location_id", "stop.order_id", "stop.location_name")


@query
def stops_with_totals(spark, folder):
    rows = reports.stops_with_totals(_solutions(spark, folder))
    return rows.withColumn("dispatched_date", F.col("dispatched_date").cast("string"))


@query
def stops_joined_to_runs(spark, folder):
    """The same from stored stops and summaries, joined."""
    table = stored(_solutions(spark, folder), "solutions")
    drivers = config.driver_ids()
    joined = reports.join_stops_to_runs(
        solutions.driver_stops(table), solutions.run_summary(table, drivers), drivers
    )
    return joined.withColumn("dispatched_date", F.col("dispatched_date").cast("string"))


@query
def driver_totals(spark, folder):
    return reports.sorted_totals(reports.driver_totals(_stops(spark, folder)))


@query
def driver_performance(spark, folder):
    rows = reports.driver_performance(_solutions(spark, folder))
    return reports.sorted_performance(rows.withColumn("dispatched_date", F.col("dispatched_date").cast("string")))


@query
def unserved_runs(spark, folder):
    rows = reports.unserved_runs(_solutions(spark, folder))
    return rows.withColumn("dispatched_date", F.col("dispatched_date").cast("string"))


@query
def late_runs(spark, folder):
    rows = reports.late_runs(_solutions(spark, folder))
    return rows.withColumn("dispatched_date", F.col("dispatched_date").cast("string"))


@query
def all_stops_sorted(spark, folder):
    return reports.sorted_stops(_stops(spark, folder))


@query
def top_stops_of_driver(spark, folder):
    return reports.top_stops_of(_stops(spark, folder), SHOWN_DRIVER)


@query
def top_stops_per_driver(spark, folder):
    rows = reports.top_stops_per_driver(_stops(spark, folder))
    return rows.withColumn("rank", number("rank"))


@query
def status_sample(spark, folder):
    rows = reports.dispatch_status(_mixed_statuses(spark, folder), SHOWN_ROWS)
    return rows.select("order_id", "status", stamp("order_timestamp").alias("order_timestamp"))


@query
def served_customers(spark, folder):
    served = solutions.served_customers(_solutions(spark, folder), F.lit(AS_OF).cast("date"))
    at = stamp("new_finish_time")
    return served.select(
        "customer_id", "finish_time", at.alias("new_finish_time"), text.file_safe(at).alias("file_label")
    )


def _ready_and_served(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    ready = orders.with_status(testdata.paid_orders(spark, folder), config.READY_FOR_DISPATCH)
    return ready, solutions.served_customers(_solutions(spark, folder), F.lit(AS_OF).cast("date"))


@query
def mark_dispatched(spark, folder):
    ready, served = _ready_and_served(spark, folder)
    marked = sinks.new_version(solutions.mark_dispatched(ready, served), scratch_path(spark, "orders"))
    return tables.read_table(spark, marked).select(
        "order_id", "customer_id", "status", stamp("order_timestamp").alias("order_timestamp")
    )


@query
def dispatched_orders(spark, folder):
    ready, served = _ready_and_served(spark, folder)
    return solutions.dispatched_orders(ready, served).select(
        "order_id", "customer_id", "status", stamp("order_timestamp").alias("order_timestamp")
    )


@query
def client_order_export(spark, folder):
    """Clients by way of a CSV file, documents by way of JSON lines."""
    root = scratch_path(spark, "clients")
    testdata.clients(spark, folder).write.option("header", "true").csv(f"{root}/clients")
    key = F.regexp_extract("customer_id", r"(\d+)$", 1).cast("bigint")
    wanted = testdata.flat_orders(spark, folder).select(
        key.alias("client_id"),
        "order_id",
        F.pmod(F.col("total_weight").cast("int"), F.lit(9)).alias("n_objects"),
        F.col("total_volume").alias("volume"),
        F.col("total_weight").alias("weight"),
    )
    clients = files.read_clients(spark, f"{root}/clients")
    sinks.append_json_lines(exports.order_documents(exports.client_orders(wanted, clients)), f"{root}/documents")
    documents = files.read_documents(spark, f"{root}/documents", schemas.SIMPLE_ORDER, multi_line=False)
    return documents.select(
        "client_id",
        "location.address",
        "location.lat",
        "location.lon",
        "order_id",
        number("order.n_objects").alias("n_objects"),
        "order.volume",
        "order.weight",
        "status",
    )


@query
def map_locations(spark, folder):
    """Locations that arrive as maps of texts, typed."""
    rows = testdata.clients(spark, folder).select(
        "client_id",
        F.create_map(
            F.lit("address"), F.col("address"), F.lit("lat"), F.col("lat").cast("string"),
            F.lit("lon"), F.col("lon").cast("string"),
        ).alias("location"),
    )
    typed = rows.select("client_id", typed_location(F.col("location")).alias("location"))
    return drop_fields(typed, "location", "address").select("client_id", "location.lat", "location.lon")


@query
def compacted_orders(spark, folder):
    """Three appends to a partitioned table, rewritten into few files."""
    root = scratch_path(spark, "compaction")
    gold = _gold(spark, folder).withColumn("label", F.date_format(PERIOD, "yyyy-MM"))
    for depot in config.DEPOTS:
        sinks.append(gold.filter(F.col("depot") == depot.name), f"{root}/appended", ["label"])
    path = sinks.compacted(spark, f"{root}/appended", f"{root}/compacted", ["label"])
    return _gold_columns(tables.read_table(spark, path))


# --- streams ------------------------------------------------------------------------------------


def _streamed(stream: DataFrame, root: str, name: str, timers: bool = False, by: Sequence[str] = ()) -> DataFrame:
    streams.finish(streams.start(stream, f"{root}/{name}", f"{root}/checkpoint-{name}", by=by, timers=timers))
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/{name}")


def _streamed_silver(spark: SparkSession, folder: str, root: str) -> DataFrame:
    sinks.write_payloads(testdata.order_events(spark, folder), f"{root}/events")
    events = tables.read_json_events(spark, f"{root}/events", schemas.EVENT)
    return _streamed(streams.silver_stream(events), root, "silver")


def _streamed_gold(spark: SparkSession, folder: str, root: str) -> DataFrame:
    silver = orders.silver_orders(testdata.order_events(spark, folder))
    silver.write.parquet(f"{root}/silver")
    stream = tables.read_stream(spark, f"{root}/silver", silver.schema)
    return _streamed(streams.gold_stream(stream), root, "gold")


@query
def stream_silver_orders(spark, folder):
    silver = _streamed_silver(spark, folder, scratch_path(spark, "stream"))
    return silver.select(
        "event_id",
        "order_id",
        "order_details_customer_id",
        "order_details_total_weight",
        "lat",
        "lon",
        "depot",
        stamp("order_timestamp").alias("order_timestamp"),
        number(F.size("order_details_items")).alias("items"),
    )


@query
def stream_gold_orders(spark, folder):
    return _gold_columns(_streamed_gold(spark, folder, scratch_path(spark, "stream")))


def _stored_flat(spark: SparkSession, folder: str, root: str) -> DataFrame:
    testdata.flat_orders(spark, folder).write.parquet(f"{root}/flat")
    return tables.read_rewritten_stream(spark, f"{root}/flat", schemas.FLAT_ORDER)


@query
def stream_ready_orders(spark, folder):
    root = scratch_path(spark, "stream")
    testdata.paid_orders(spark, folder).drop(PERIOD).write.parquet(f"{root}/gold")
    gold = tables.read_stream_from(spark, f"{root}/gold", schemas.GOLD_ORDER, "earliest")
    ready = streams.ready_stream(gold).withColumn("label", F.date_format("hour", "yyyy-MM"))
    return _gold_columns(_streamed(ready, root, "ready", by=["label"]))


@query
def stream_status_by_hour(spark, folder):
    root = scratch_path(spark, "stream")
    stream = streams.hourly_status_stream(_stored_flat(spark, folder, root))
    return _streamed(stream, root, "by-hour").select("order_id", "status", "order_hour")


@query
def stream_tumbling_totals(spark, folder):
    """Closed windows only: the last one stays open until later orders come."""
    root = scratch_path(spark, "stream")
    totals = _streamed(streams.tumbling_stream(_stored_flat(spark, folder, root)), root, "totals")
    return totals.select(
        stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"), "total_weight", "total_volume"
    )


@query
def stream_window_lists(spark, folder):
    root = scratch_path(spark, "stream")
    bronze = _stored_flat(spark, folder, root)
    totals = _streamed(streams.window_totals_stream(bronze), root, "window-totals")
    members = _streamed(streams.window_member_stream(bronze), root, "window-members")
    return members.join(totals, "window_start").select(
        stamp("window_start").alias("window_start"),
        "order_id",
        "total_weight",
        "total_volume",
        "accumulated_volume",
        "accumulated_weight",
        "window_orders",
    )


#: The days at which the flushing streams are fed the next orders, one run for each part.
FEED_DAYS = ("1997-01-01", "1999-01-01")
LANES = 4


def _fed(spark: SparkSession, folder: str, root: str, run: Callable[[DataFrame, int], None]) -> None:
    """Paid orders as a stream that gets them in time order: each part is written, then ``run`` once."""
    paid = stored(testdata.paid_orders(spark, folder).drop(PERIOD), "paid")
    borders = [None, *FEED_DAYS, None]
    for part, (since, until) in enumerate(zip(borders, borders[1:], strict=False)):
        rows = paid
        if since:
            rows = rows.filter(F.col("order_timestamp") >= F.lit(since).cast("timestamp"))
        if until:
            rows = rows.filter(F.col("order_timestamp") < F.lit(until).cast("timestamp"))
        rows.write.mode("append").parquet(f"{root}/paid")
        run(tables.read_stream(spark, f"{root}/paid", schemas.GOLD_ORDER), part)


@query
def stream_threshold_flush(spark, folder):
    """Each depot has several buffers; a run sees later orders than the one before, so releases are those of a batch."""
    root = scratch_path(spark, "stream")
    limits = Limits(FLUSH.weight, FLUSH.volume)

    def run(stream: DataFrame, part: int) -> None:
        released = flush.threshold_stream(stream, "depot", limits, lanes=LANES)
        streams.finish(streams.start(released, f"{root}/released", f"{root}/checkpoint", buffers=True))

    _fed(spark, folder, root, run)
    totals = flush.totals_by_release(tables.read_table(spark, f"{root}/released"))
    return totals.withColumn("lane", number("lane"))


@query
def stream_late_orders(spark, folder):
    """Later orders come first: windows of the earlier ones are closed by then, so those orders are dropped and counted."""
    root = scratch_path(spark, "stream")
    flat, day = testdata.flat_orders(spark, folder), F.lit(FEED_DAYS[0]).cast("timestamp")
    late = 0
    for rows in (flat.filter(F.col("order_timestamp") >= day), flat.filter(F.col("order_timestamp") < day)):
        rows.write.mode("append").parquet(f"{root}/flat")
        totals = streams.tumbling_stream(tables.read_stream(spark, f"{root}/flat", schemas.FLAT_ORDER))
        running = streams.start(totals, f"{root}/totals", f"{root}/checkpoint")
        streams.finish(running)
        late += streams.late_rows(running)
    return tables.read_table(spark, f"{root}/totals").select(
        stamp("window_start").alias("window_start"), "total_weight", "total_volume", F.lit(late > 0).alias("some_late")
    )


@query
def stream_from_now(spark, folder):
    """A stream that starts when part of the orders are there already takes only those that come after."""
    root = scratch_path(spark, "stream")
    flat, day = testdata.flat_orders(spark, folder), F.lit(FEED_DAYS[0]).cast("timestamp")
    flat.filter(F.col("order_timestamp") < day).write.parquet(f"{root}/flat")
    now = tables.written_until(spark, f"{root}/flat")
    flat.filter(F.col("order_timestamp") >= day).write.mode("append").parquet(f"{root}/flat")
    stream = tables.read_stream_from(spark, f"{root}/flat", schemas.FLAT_ORDER, now)
    return _streamed(stream, root, "taken").select("order_id", stamp("order_timestamp").alias("order_timestamp"))


@query
def stream_archived_inputs(spark, folder):
    """Inputs move to the archive once a later run shows that they are done with; no order is lost."""
    root = scratch_path(spark, "stream")

    def run(_: DataFrame, part: int) -> None:
        stream = tables.read_archiving_stream(spark, f"{root}/paid", schemas.GOLD_ORDER, f"{root}/archive")
        streams.finish(streams.start(stream, f"{root}/taken", f"{root}/checkpoint"))

    _fed(spark, folder, root, run)
    archived = F.lit(tables.table_exists(spark, f"{root}/archive")).alias("some_archived")
    taken = tables.read_table(spark, f"{root}/taken")
    return taken.select("order_id", stamp("order_timestamp").alias("order_timestamp"), archived)


@query
def stream_cutoff_flush(spark, folder):
    """Tested once a run: before noon only a full buffer goes, after noon everything. One buffer is never full."""
    root = scratch_path(spark, "stream")
    cases = {"full": config.CUTOFF_LIMITS, "never_full": Limits(1e15, 1e15)}
    clocks = ("09:00", "11:59", config.CUTOFF_CLOCK)

    def run(stream: DataFrame, part: int) -> None:
        for case, limits in cases.items():
            released = flush.threshold_stream(
                stream, "depot", limits, per_order=False, cutoff=config.CUTOFF_CLOCK, clock=clocks[part]
            )
            streams.finish(streams.start(released, f"{root}/{case}", f"{root}/checkpoint-{case}", timers=True, buffers=True))

    _fed(spark, folder, root, run)
    parts = [
        flush.totals_by_release(tables.read_table(spark, f"{root}/{case}"), ("key", "release")).withColumn("buffer", F.lit(case))
        for case in cases
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_publish(spark, folder):
    root = scratch_path(spark, "stream")
    records = _streamed(streams.publish(_stored_flat(spark, folder, root)), root, "records")
    parsed = records.select("key", F.from_json("value", schemas.FLAT_ORDER).alias("order"))
    return parsed.select(
        "key",
        "order.order_id",
        "order.total_weight",
        "order.total_price",
        stamp("order.order_timestamp").alias("order_timestamp"),
    )

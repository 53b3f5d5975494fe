"""The registered queries as SQL over the given tables, for another engine to check."""

from __future__ import annotations

from parcelflow import config
from parcelflow.plans import registry
from parcelflow.sources import testdata

_DEPOTS = ", ".join(
    f"abs(lat - {depot.lat!r}) + abs(lon - ({depot.lng!r})) AS d{number}"
    for number, depot in enumerate(config.DEPOTS, 1)
)
_NAMES = [depot.name for depot in config.DEPOTS]

ORDERS = f"""
line_totals AS (
  SELECT l_orderkey, sum(l_quantity) AS total_weight, sum(l_quantity * p_size) AS total_volume,
         count(DISTINCT l_returnflag) AS items, count(DISTINCT l_returnflag || l_linestatus) AS packages
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
plain AS (
  SELECT o_orderkey AS number, 'ord-' || o_orderkey AS order_id, 'cus-' || o_custkey AS customer_id, o_custkey,
         total_weight, total_volume, items, packages, o_totalprice AS total_price,
         o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
         CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'PAID' END AS payment_status,
         CAST(403121 + (o_custkey * 7919) % 3400 AS DOUBLE) / 10000 AS lat,
         CAST(-38666 + (o_custkey * 104729) % 2993 AS DOUBLE) / 10000 AS lon
  FROM orders JOIN line_totals ON o_orderkey = l_orderkey),
measured AS (SELECT *, {_DEPOTS} FROM plain),
placed AS (
  SELECT *, CASE WHEN d1 <= d2 AND d1 <= d3 THEN '{_NAMES[0]}' WHEN d2 <= d3 THEN '{_NAMES[1]}'
            ELSE '{_NAMES[2]}' END AS depot
  FROM measured),
paid AS (
  SELECT *, date_trunc('month', ts) AS month_start FROM placed WHERE payment_status = 'PAID')"""

PACKED = f"""{ORDERS},
summed AS (
  SELECT *, sum(total_weight) OVER fifo AS cum_weight, sum(total_volume) OVER fifo AS cum_volume
  FROM paid
  WINDOW fifo AS (PARTITION BY month_start ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING)),
packed AS (
  SELECT *, CAST(greatest(ceil(cum_volume / {config.PACK_LIMITS.volume!r}),
                          ceil(cum_weight / {config.PACK_LIMITS.weight!r})) AS BIGINT) AS batch_id
  FROM summed)"""

_PER_DEPOT = config.Fleet().drivers_per_depot
RUNS = f"""{ORDERS},
routed AS (
  SELECT number // {testdata.RUN_SIZE} AS run, 1 + number % {testdata.BUSY_DRIVERS} AS driver,
         540 + (number * 7) % 540 AS minute, number % 50 = 0 AS unserved, order_id, customer_id, total_weight
  FROM paid),
runs AS (
  SELECT run, 'run-' || run AS id,
         TIMESTAMP '{testdata.FIRST_RUN}'
           + to_seconds((run * {testdata.RUN_SPACING}) % {testdata.RUN_SPAN}) AS done_at,
         strftime(done_at, '%Y-%m-%dT%H:%M:%SZ') AS finished_at,
         strftime(done_at, '%Y-%m-%d') AS dispatched_date,
         CASE WHEN run % 10 = 9 THEN 'UNKNOWN'
              ELSE strftime(make_timestamp(CAST(floor(epoch(done_at) / 1800.0 + 0.5) AS BIGINT) * 1800 * 1000000),
                            '%Y-%m-%d-%H-%M') END AS dispatched_hour
  FROM (SELECT DISTINCT run FROM routed)),
routes AS (
  SELECT run, driver, 'driver_' || driver AS driver_id, 1 + (driver - 1) // {_PER_DEPOT} AS depot_number,
         1.0 + coalesce(sum(total_weight) FILTER (NOT unserved), 0.0) AS distance,
         count(*) FILTER (NOT unserved AND minute > {testdata.LATE_MINUTE}) AS late,
         count(*) FILTER (NOT unserved) AS visits
  FROM routed GROUP BY run, driver),
totals AS (
  SELECT run, CAST(sum(CASE WHEN unserved THEN 0 ELSE 1 END) AS BIGINT) AS served,
         count(*) FILTER (unserved) AS num_unserved,
         coalesce(string_agg(order_id, ',' ORDER BY order_id) FILTER (unserved), '') AS unserved,
         count(*) FILTER (NOT unserved AND minute > {testdata.LATE_MINUTE}) AS num_late_visits,
         CAST(coalesce(sum(minute - {testdata.LATE_MINUTE})
              FILTER (NOT unserved AND minute > {testdata.LATE_MINUTE}), 0) AS BIGINT) AS total_visit_lateness
  FROM routed GROUP BY run),
solved AS (
  SELECT runs.*, totals.* EXCLUDE (run), total_distance, drivers
  FROM runs JOIN totals USING (run)
  JOIN (SELECT run, sum(distance) AS total_distance, count(*) AS drivers FROM routes GROUP BY run) USING (run)),
stops AS (
  SELECT run, 'driver_' || driver AS driver_id, order_id AS location_id, customer_id AS location_name,
         lpad(CAST(minute // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute % 60 AS VARCHAR), 2, '0')
           AS arrival_time,
         lpad(CAST((minute + 5) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((minute + 5) % 60 AS VARCHAR), 2, '0')
           AS finish_time,
         total_weight AS distance
  FROM routed WHERE NOT unserved
  UNION ALL
  SELECT run, driver_id, 'depot_' || depot_number, ['{"', '".join(_NAMES)}'][depot_number], e.clock, e.clock, e.distance
  FROM routes, (VALUES ('09:00', 0.0::DOUBLE), ('18:30', 1.0::DOUBLE)) AS e(clock, distance)),
driver_stops AS (
  SELECT id, dispatched_date, finished_at, driver_id, arrival_time, distance, finish_time, location_id, location_name, run
  FROM stops JOIN runs USING (run))"""

_STAMP = "'%Y-%m-%d %H:%M:%S'"


def stamp(value: str, name: str) -> str:
    return f"strftime({value}, {_STAMP}) AS {name}"


def window_start(length: int, ts: str = "ts") -> str:
    return f"make_timestamp(CAST(floor(epoch({ts}) / {length}.0) AS BIGINT) * {length} * 1000000)"


_WEEK = window_start(604800)
_GOLD = f"""order_id, customer_id, total_weight, total_volume, total_price, {stamp('ts', 'order_timestamp')},
  {{status}} AS status, lat, lon, depot, {stamp("date_trunc('hour', ts)", 'hour')}"""
_MIXED = f"""{ORDERS},
mixed AS (
  SELECT *, ['RECEIVED', 'in_progress', 'READY_FOR_DISPATCH', 'DISPATCHED'][number % 4 + 1] AS status FROM placed)"""
_MONTH = stamp("month_start", "month")
_DRIVERS = config.driver_ids()
_STOP_ORDER = "finished_at, arrival_time, id, location_id"
_TOTALS = """'success' AS status, CAST(0 AS BIGINT) AS total_break_time, total_distance,
  served % 7 AS total_idle_time, served * 5 AS total_travel_time, num_late_visits AS total_vehicle_overtime,
  total_visit_lateness, served * 10 AS total_working_time, num_late_visits, num_unserved, unserved"""

# The release of an order depends on all orders of its depot before it: one step per order.
_FLUSHED = f"""WITH RECURSIVE {ORDERS},
lined AS (
  SELECT depot, order_id, total_weight AS w, total_volume AS v, ts,
         row_number() OVER (PARTITION BY depot ORDER BY ts, order_id) AS place
  FROM paid),
walk AS (
  SELECT depot, order_id, place, CAST(0 AS BIGINT) AS flush_id, w, v, ts AS since, ts,
         w >= {{weight}} OR v >= {{volume}} AS released
  FROM lined WHERE place = 1
  UNION ALL
  SELECT n.depot, n.order_id, n.place, p.flush_id + CAST(p.released AS BIGINT),
         CASE WHEN p.released THEN n.w ELSE p.w + n.w END,
         CASE WHEN p.released THEN n.v ELSE p.v + n.v END,
         CASE WHEN p.released THEN p.ts ELSE p.since END,
         n.ts,
         CASE WHEN p.released THEN n.w ELSE p.w + n.w END >= {{weight}}
           OR CASE WHEN p.released THEN n.v ELSE p.v + n.v END >= {{volume}}
           OR epoch(n.ts) - epoch(CASE WHEN p.released THEN p.ts ELSE p.since END) >= {{seconds}}
  FROM walk p JOIN lined n ON n.depot = p.depot AND n.place = p.place + 1)"""

_LORRIES = f"""WITH RECURSIVE {ORDERS},
lined AS (
  SELECT {_WEEK} AS window_at, order_id, total_weight AS w, total_volume AS v,
         row_number() OVER (PARTITION BY {_WEEK} ORDER BY ts, order_id) AS place
  FROM paid),
walk AS (
  SELECT window_at, CAST(0 AS BIGINT) AS place, CAST(NULL AS VARCHAR) AS order_id, false AS loaded,
         0.0::DOUBLE AS w, 0.0::DOUBLE AS v, 0.0::DOUBLE AS own_w, 0.0::DOUBLE AS own_v
  FROM (SELECT DISTINCT window_at FROM lined)
  UNION ALL
  SELECT n.window_at, n.place, n.order_id, fits, p.w + CASE WHEN fits THEN n.w ELSE 0.0 END,
         p.v + CASE WHEN fits THEN n.v ELSE 0.0 END, n.w, n.v
  FROM (SELECT window_at, place, w, v FROM walk) p
  JOIN lined n ON n.window_at = p.window_at AND n.place = p.place + 1,
  LATERAL (SELECT p.w + n.w <= {config.LORRY_LIMITS.weight!r} AND p.v + n.v <= {config.LORRY_LIMITS.volume!r} AS fits))"""
_LORRY_STATUS = "CASE WHEN loaded THEN 'READY_FOR_DISPATCH' ELSE 'RECEIVED' END AS status"

_JOINED_STOPS = """finished_at, dispatched_date, s.driver_id, arrival_time, s.distance AS segment_distance, finish_time,
  location_id, location_name, 'success' AS status, total_distance, served * 5 AS total_travel_time,
  r.distance AS total_driver_distance
FROM stops s JOIN solved USING (run) JOIN routes r ON r.run = s.run AND r.driver_id = s.driver_id"""

_SERVED = f"""{RUNS},
served AS (
  SELECT location_name AS customer_id, finish_time,
         strptime('2024-10-06 ' || finish_time, '%Y-%m-%d %H:%M') AS new_finish_time
  FROM driver_stops WHERE location_name LIKE 'cus-%'),
latest AS (SELECT customer_id, max(new_finish_time) AS new_finish_time FROM served GROUP BY customer_id)"""

_REPORT = f"""SELECT finished_at, dispatched_hour, dispatched_date, 'success' AS output_status,
  served * 5 AS output_total_travel_time, total_visit_lateness AS output_total_visit_lateness,
  num_late_visits AS output_num_late_visits, num_unserved AS output_num_unserved,
  total_distance AS output_total_distance, unserved AS output_unserved, drivers
FROM solved"""

SQL: dict[str, str] = {
    "flatten_events": f"""WITH {ORDERS}
SELECT 'evt-' || number AS event_id, {stamp('ts', 'event_timestamp')}, order_id,
  customer_id AS order_details_customer_id, strftime(ts, '%Y-%m-%d') AS order_details_order_date,
  total_price AS order_details_total_amount, total_volume AS order_details_total_volume,
  total_weight AS order_details_total_weight,
  CAST(o_custkey % 200 AS VARCHAR) AS order_details_destination_address_house_number,
  'Spain' AS order_details_destination_address_country,
  payment_status AS order_details_payment_details_payment_status,
  'trx-' || number AS order_details_payment_details_transaction_id,
  lat, lon, depot, {stamp('ts', 'order_timestamp')}, items, CAST(total_weight AS BIGINT) AS quantity, packages
FROM placed""",
    "parsed_order_times": f"""WITH {ORDERS}
SELECT order_id, {stamp('ts', 'parsed_at')}, {stamp('ts', 'at_by_cast')}, {stamp("date_trunc('hour', ts)", 'hour')},
  strftime(ts, '%y-%m-%d-%H') AS hour_label, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS file_label,
  strftime(ts, '%Y-%m-%d') AS day, strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day
FROM plain""",
    "gold_paid_orders": f"WITH {ORDERS} SELECT {_GOLD.format(status=repr('RECEIVED'))} FROM paid",
    "nearest_depot": f"WITH {ORDERS} SELECT order_id, depot, least(d1, d2, d3) AS distance FROM placed",
    "nearest_depot_of_table": f"""WITH {ORDERS},
sites AS (
  SELECT c_custkey AS place, (403121 + (c_custkey * 3571) % CASE WHEN c_custkey % 3 = 0 THEN 40 ELSE 3400 END)::DOUBLE / 10000 AS y,
    (-38666 + (c_custkey * 8461) % CASE WHEN c_custkey % 3 = 0 THEN 40 ELSE 2993 END)::DOUBLE / 10000 AS x FROM customer),
spots AS (SELECT DISTINCT lat, lon FROM plain),
ranked AS (
  SELECT lat, lon, place, abs(lat - y) + abs(lon - x) AS distance FROM spots CROSS JOIN sites
  QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY abs(lat - y) + abs(lon - x), place) = 1)
SELECT order_id, 'site-' || place AS depot, distance FROM plain JOIN ranked USING (lat, lon)""",
    "status_transition": f"""WITH {_MIXED}
SELECT order_id, CASE WHEN status = 'RECEIVED' THEN 'READY_FOR_DELIVERY' ELSE status END AS status,
  strftime(ts, '%y-%m-%d-%H') AS order_hour, 'READY' AS status_for_packing
FROM mixed""",
    "status_counts": f"""WITH {_MIXED},
chosen AS (
  SELECT 'new' AS choice, status FROM mixed WHERE status = 'in_progress'
  UNION ALL SELECT 'ready', status FROM mixed WHERE status = 'READY_FOR_DISPATCH'
  UNION ALL SELECT 'shown', status FROM mixed WHERE status IN ('DISPATCHED', 'READY_FOR_DISPATCH'))
SELECT choice, status, count(*) AS orders FROM chosen GROUP BY choice, status""",
    "fifo_capacity_batches": f"""WITH {PACKED}
SELECT order_id, {_MONTH}, 'READY_FOR_DISPATCH' AS status, batch_id FROM packed""",
    "batch_totals": f"""WITH {PACKED}
SELECT {_MONTH}, batch_id, count(*) AS orders, sum(total_weight) AS total_weight, sum(total_volume) AS total_volume,
  {stamp('min(ts)', 'first_order')}, {stamp('max(ts)', 'last_order')}
FROM packed GROUP BY month_start, batch_id""",
    "tumbling_totals": f"""WITH {ORDERS}
SELECT {stamp(window_start(120), 'window_start')}, sum(total_weight) AS total_weight, sum(total_volume) AS total_volume
FROM plain GROUP BY 1""",
    "window_threshold_clamp": f"""WITH {ORDERS},
weekly AS (
  SELECT {_WEEK} AS window_at, sum(total_volume) AS accumulated_volume, sum(total_weight) AS accumulated_weight,
         count(*) AS orders
  FROM plain GROUP BY 1)
SELECT {stamp('window_at', 'window_start')}, accumulated_volume, accumulated_weight, orders,
  least(accumulated_volume, {config.LORRY_LIMITS.volume!r}) AS ready_volume,
  least(accumulated_weight, {config.LORRY_LIMITS.weight!r}) AS ready_weight, 'READY_FOR_DISPATCH' AS status
FROM weekly
WHERE accumulated_volume > {config.WINDOW_FLOOR.volume!r} AND accumulated_weight > {config.WINDOW_FLOOR.weight!r}""",
    "window_order_lists": f"""WITH {ORDERS}
SELECT {stamp(_WEEK, 'window_start')}, order_id, total_weight, sum(total_volume) OVER w AS accumulated_volume,
  sum(total_weight) OVER w AS accumulated_weight, count(*) OVER w AS window_orders
FROM plain WINDOW w AS (PARTITION BY {_WEEK})""",
    "window_dispatch_members": f"""WITH {ORDERS},
weekly AS (
  SELECT {_WEEK} AS window_at, order_id, sum(total_volume) OVER w AS v, sum(total_weight) OVER w AS w
  FROM plain WINDOW w AS (PARTITION BY {_WEEK}))
SELECT {stamp('window_at', 'window_start')}, order_id, least(v, {config.LORRY_LIMITS.volume!r}) AS ready_volume,
  least(w, {config.LORRY_LIMITS.weight!r}) AS ready_weight, 'READY_FOR_DISPATCH' AS status
FROM weekly WHERE v > {config.WINDOW_FLOOR.volume!r} AND w > {config.WINDOW_FLOOR.weight!r}""",
    "fractional_capacity_batches": f"""WITH {ORDERS},
summed AS (
  SELECT order_id, month_start,
    CAST(sum(CAST(total_weight / 10 AS DECIMAL(20, 6))) OVER fifo AS DOUBLE) AS cum_weight,
    CAST(sum(CAST(total_volume / 10 AS DECIMAL(20, 6))) OVER fifo AS DOUBLE) AS cum_volume
  FROM paid WINDOW fifo AS (PARTITION BY month_start ORDER BY ts, order_id ROWS UNBOUNDED PRECEDING))
SELECT order_id, {_MONTH}, CAST(greatest(ceil(cum_volume / 5000.0), ceil(cum_weight / 100.0)) AS BIGINT) AS batch_id
FROM summed""",
    "threshold_flush_batches": _FLUSHED.format(
        weight=registry.FLUSH.weight, volume=registry.FLUSH.volume, seconds=registry.FLUSH.seconds
    )
    + "\nSELECT order_id, depot, flush_id, 'READY_FOR_DISPATCH' AS status FROM walk",
    "sliced_flush_batches": _FLUSHED.format(
        weight=registry.LONG_FLUSH.weight, volume=registry.LONG_FLUSH.volume, seconds=registry.LONG_FLUSH.seconds
    )
    + "\nSELECT order_id, depot, flush_id FROM walk",
    "lorry_split": f"""{_LORRIES}
SELECT order_id, {stamp('window_at', 'window_start')}, {_LORRY_STATUS} FROM walk WHERE place > 0""",
    "lorry_lists": f"""{_LORRIES}
SELECT {stamp('window_at', 'window_start')}, {_LORRY_STATUS}, count(*) AS orders,
  sum(own_v) AS total_volume, sum(own_w) AS total_weight
FROM walk WHERE place > 0 GROUP BY window_at, loaded""",
    "fleet_assignment": f"""WITH {ORDERS},
fleet AS (
  SELECT 'driver_' || n AS driver_id, 'depot_' || (1 + (n - 1) // {_PER_DEPOT}) AS depot_id,
         ['{"', '".join(_NAMES)}'][1 + (n - 1) // {_PER_DEPOT}] AS depot
  FROM range(1, {config.Fleet().drivers + 1}) AS r(n)),
waiting AS (
  SELECT depot, count(*) AS depot_orders, sum(total_weight) AS depot_weight, sum(total_volume) AS depot_volume
  FROM paid GROUP BY depot)
SELECT depot, driver_id, depot_id, '09:00' AS shift_start, '18:00' AS shift_end, CAST(1 AS BIGINT) AS min_visits,
  1000.0::DOUBLE AS capacity_weight, 1000.0::DOUBLE AS capacity_volume, depot_orders, depot_weight, depot_volume
FROM fleet LEFT JOIN waiting USING (depot)""",
    "batch_visits": f"""WITH {PACKED}
SELECT {_MONTH}, batch_id, order_id, customer_id AS name, lat, lon AS lng,
  '09:00' AS start_time, '18:00' AS end_time, CAST(5 AS BIGINT) AS duration
FROM packed""",
    "batch_visit_loads": f"""WITH {PACKED}
SELECT {_MONTH}, batch_id, order_id, customer_id AS name, lat, lon AS lng,
  '9:00' AS start_time, CAST(ceil(total_weight) AS BIGINT) AS weight, CAST(ceil(total_volume) AS BIGINT) AS volume,
  ['low', 'regular', 'high'][CAST('0x' || substr(md5(order_id), 1, 4) AS BIGINT) % 3 + 1] AS priority
FROM packed""",
    "request_documents": f"""WITH {PACKED}
SELECT {_MONTH}, batch_id, count(*) AS visits, CAST(18 AS BIGINT) AS drivers,
  'depot_2' AS depot_of_driver_7, 'slow' AS traffic, true AS balance
FROM packed GROUP BY month_start, batch_id""",
    "pending_jobs": f"""WITH {ORDERS}
SELECT DISTINCT strftime(month_start, '%Y-%m') AS job_id FROM paid WHERE month(month_start) % 3 = 0""",
    "solution_load": f"""WITH {RUNS}
SELECT id, finished_at, dispatched_hour, dispatched_date, num_late_visits, num_unserved, total_distance, drivers
FROM solved""",
    "solution_reloads": f"""WITH {RUNS},
marked AS (SELECT *, run % 3 <> 0 AND run % 4 = 1 AS fixed FROM solved)
SELECT id, strftime(done_at + CASE WHEN fixed THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%dT%H:%M:%SZ') AS finished_at,
  CASE WHEN fixed THEN 'UNKNOWN' ELSE dispatched_hour END AS dispatched_hour,
  strftime(done_at + CASE WHEN fixed THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, '%Y-%m-%d') AS dispatched_date,
  num_late_visits, num_unserved, total_distance, drivers, CASE WHEN fixed THEN 'corrected' ELSE 'madrid' END AS region
FROM marked""",
    "solution_reloads_by_date": f"""WITH {RUNS},
marked AS (
  SELECT id, run % 3 <> 0 AND run % 4 = 1 AS fixed, done_at + CASE WHEN fixed THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS moved FROM runs)
SELECT id, CASE WHEN fixed THEN 'corrected' ELSE 'madrid' END AS region, strftime(moved, '%Y-%m-%dT%H:%M:%SZ') AS finished_at,
  strftime(moved, '%Y-%m-%d_%H-%M-%S') AS finished_at_clean, strftime(moved, '%Y-%m-%d') AS dispatched_date,
  strftime(moved + INTERVAL 1 DAY, '%Y-%m-%d') AS bronze_date, finished_at_clean AS drawn_at
FROM marked""",
    "multi_line_answers": f"""WITH {RUNS}
SELECT id, finished_at, dispatched_hour, dispatched_date, num_late_visits, num_unserved, total_distance, drivers
FROM solved""",
    "solution_tables_by_date": f"""WITH {RUNS}
SELECT id, 'finished' AS status, finished_at, 'request-' || run AS input, 'madrid' AS region,
  strftime(done_at, '%Y-%m-%d_%H-%M-%S') AS finished_at_clean, dispatched_date,
  strftime(done_at + INTERVAL 1 DAY, '%Y-%m-%d') AS bronze_date
FROM runs""",
    "route_archive": f"""WITH {RUNS}
SELECT 'request-' || run AS input, dispatched_hour, count(*) AS stops
FROM stops JOIN runs USING (run) GROUP BY run, dispatched_hour""",
    "route_polylines": f"""WITH {RUNS}
SELECT strftime(done_at, '%Y-%m-%d_%H-%M-%S') AS finished_at_clean, driver_id, visits + 2 AS points
FROM routes JOIN runs USING (run)""",
    "report_table": f"WITH {RUNS} {_REPORT}",
    "catalog_report_table": f"WITH {RUNS} {_REPORT}",
    "trimmed_answers": f"""WITH {RUNS}
SELECT finished_at, dispatched_date,
  'distances,num_late_visits,num_unserved,solution,status,total_break_time,total_distance,total_idle_time,'
  || 'total_travel_time,total_vehicle_overtime,total_visit_lateness,total_working_time,unserved,vehicle_overtime'
    AS fields, total_distance
FROM solved""",
    "views_by_run": f"""WITH {RUNS}
SELECT 'dispatched_orders_' || translate(finished_at, '-:.', '___') AS view_name, finished_at, count(*) AS runs
FROM runs GROUP BY finished_at""",
    "latest_run_view": f"WITH {RUNS} {_REPORT} WHERE finished_at = (SELECT max(finished_at) FROM solved)",
    "driver_stops": f"WITH {RUNS} SELECT * EXCLUDE (run) FROM driver_stops",
    "run_summary_flat": f"""WITH {RUNS},
wide AS (
  SELECT run, {', '.join(f"max(distance) FILTER (driver_id = '{d}') AS distance_{d}" for d in _DRIVERS)},
         {', '.join(f"max(late) FILTER (driver_id = '{d}') AS overtime_{d}" for d in _DRIVERS)}
  FROM routes GROUP BY run)
SELECT id, dispatched_date, finished_at, {_TOTALS}, wide.* EXCLUDE (run) FROM solved JOIN wide USING (run)""",
    "solution_key_rename": f"""WITH {RUNS}
SELECT id, driver_id, CASE WHEN location_id LIKE 'depot!_%' ESCAPE '!' THEN location_id END AS location_id,
  CASE WHEN location_id NOT LIKE 'depot!_%' ESCAPE '!' THEN location_id END AS order_id, location_name
FROM driver_stops""",
    "stops_with_totals": f"WITH {RUNS} SELECT id, {_JOINED_STOPS}",
    "stops_joined_to_runs": f"WITH {RUNS} SELECT {_JOINED_STOPS}",
    "driver_totals": f"""WITH {RUNS}
SELECT driver_id, sum(distance) AS total_route_distance, count(*) AS num_stops FROM driver_stops GROUP BY driver_id""",
    "driver_performance": f"""WITH {RUNS}
SELECT id, d.driver_id, dispatched_date, finished_at, distance AS total_distance, late AS total_overtime
FROM runs CROSS JOIN (SELECT unnest(['{"', '".join(_DRIVERS)}']) AS driver_id) d
LEFT JOIN routes ON routes.run = runs.run AND routes.driver_id = d.driver_id""",
    "unserved_runs": f"""WITH {RUNS}
SELECT id, dispatched_date, finished_at, unserved FROM solved WHERE unserved IS NOT NULL AND unserved <> ''""",
    "late_runs": f"""WITH {RUNS}
SELECT id, dispatched_date, finished_at, num_late_visits, total_visit_lateness FROM solved WHERE num_late_visits > 0""",
    "all_stops_sorted": f"WITH {RUNS} SELECT * EXCLUDE (run) FROM driver_stops ORDER BY driver_id, {_STOP_ORDER}",
    "top_stops_of_driver": f"""WITH {RUNS}
SELECT * EXCLUDE (run) FROM driver_stops WHERE driver_id = '{registry.SHOWN_DRIVER}' ORDER BY {_STOP_ORDER} LIMIT 20""",
    "top_stops_per_driver": f"""WITH {RUNS}
SELECT * EXCLUDE (run), row_number() OVER (PARTITION BY driver_id ORDER BY {_STOP_ORDER}) AS rank
FROM driver_stops QUALIFY rank <= 20""",
    "status_sample": f"""WITH {_MIXED}
SELECT order_id, status, {stamp('ts', 'order_timestamp')} FROM mixed
WHERE status IN ('DISPATCHED', 'READY_FOR_DISPATCH') ORDER BY ts, order_id LIMIT {registry.SHOWN_ROWS}""",
    "served_customers": f"""WITH {_SERVED}
SELECT customer_id, finish_time, {stamp('new_finish_time', 'new_finish_time')},
  strftime(new_finish_time, '%Y-%m-%d-%H-%M-%S') AS file_label
FROM served""",
    "mark_dispatched": f"""WITH {_SERVED}
SELECT order_id, customer_id, CASE WHEN l.customer_id IS NULL THEN 'READY_FOR_DISPATCH' ELSE 'DISPATCHED' END AS status,
  {stamp('CASE WHEN l.customer_id IS NULL THEN ts ELSE new_finish_time END', 'order_timestamp')}
FROM paid LEFT JOIN latest l USING (customer_id)""",
    "dispatched_orders": f"""WITH {_SERVED}
SELECT order_id, customer_id, 'DISPATCHED' AS status, {stamp('new_finish_time', 'order_timestamp')}
FROM paid JOIN latest USING (customer_id)""",
    "client_order_export": f"""WITH {ORDERS}
SELECT o_custkey AS client_id, c_name AS address, lat, lon, order_id,
  CAST(total_weight AS BIGINT) % 9 AS n_objects, total_volume AS volume, total_weight AS weight, 'active' AS status
FROM plain JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0""",
    "map_locations": """
SELECT c_custkey AS client_id, CAST(403121 + (c_custkey * 7919) % 3400 AS DOUBLE) / 10000 AS lat,
  CAST(-38666 + (c_custkey * 104729) % 2993 AS DOUBLE) / 10000 AS lon
FROM customer""",
    "compacted_orders": f"WITH {ORDERS} SELECT {_GOLD.format(status=repr('RECEIVED'))} FROM paid",
    "stream_silver_orders": f"""WITH {ORDERS}
SELECT 'evt-' || number AS event_id, order_id, customer_id AS order_details_customer_id,
  total_weight AS order_details_total_weight, lat, lon, depot, {stamp('ts', 'order_timestamp')}, items
FROM placed""",
    "stream_gold_orders": f"WITH {ORDERS} SELECT {_GOLD.format(status=repr('RECEIVED'))} FROM paid",
    "stream_ready_orders": f"WITH {ORDERS} SELECT {_GOLD.format(status=repr('READY'))} FROM paid",
    "stream_status_by_hour": f"""WITH {ORDERS}
SELECT order_id, 'READY_FOR_DELIVERY' AS status, strftime(ts, '%y-%m-%d-%H') AS order_hour FROM plain""",
    "stream_tumbling_totals": f"""WITH {ORDERS},
windows AS (
  SELECT {window_start(120)} AS opened, sum(total_weight) AS total_weight, sum(total_volume) AS total_volume
  FROM plain GROUP BY 1)
SELECT {stamp('opened', 'window_start')}, {stamp('opened + INTERVAL 2 MINUTE', 'window_end')}, total_weight, total_volume
FROM windows WHERE opened + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM plain) - INTERVAL 1 MINUTE""",
    "stream_late_orders": f"""WITH {ORDERS},
windows AS (
  SELECT {window_start(120)} AS opened, sum(total_weight) AS total_weight, sum(total_volume) AS total_volume
  FROM plain WHERE ts >= TIMESTAMP '{registry.FEED_DAYS[0]}' GROUP BY 1)
SELECT {stamp('opened', 'window_start')}, total_weight, total_volume, true AS some_late
FROM windows WHERE opened + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM plain) - INTERVAL 1 MINUTE""",
    "stream_archived_inputs": f"""WITH {ORDERS}
SELECT order_id, {stamp('ts', 'order_timestamp')}, true AS some_archived FROM paid""",
    "stream_from_now": f"""WITH {ORDERS}
SELECT order_id, {stamp('ts', 'order_timestamp')} FROM plain WHERE ts >= TIMESTAMP '{registry.FEED_DAYS[0]}'""",
    "stream_window_lists": f"""WITH {ORDERS}
SELECT {stamp(window_start(600), 'window_start')}, order_id, total_weight, total_volume,
  sum(total_volume) OVER w AS accumulated_volume, sum(total_weight) OVER w AS accumulated_weight,
  count(*) OVER w AS window_orders FROM plain
WHERE {window_start(600)} + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM plain) - INTERVAL 1 MINUTE
WINDOW w AS (PARTITION BY {window_start(600)})""",
    "stream_threshold_flush": f"""WITH RECURSIVE {ORDERS},
lined AS (
  SELECT depot, lane, total_weight AS w, total_volume AS v,
         row_number() OVER (PARTITION BY depot, lane ORDER BY ts, order_id) AS place
  FROM (SELECT *, CAST('0x' || substr(md5(order_id), 1, 4) AS BIGINT) % {registry.LANES} AS lane FROM paid)),
walk AS (
  SELECT depot, lane, place, CAST(0 AS BIGINT) AS release, w AS own_w, v AS own_v, w, v,
         w >= {registry.FLUSH.weight!r} OR v >= {registry.FLUSH.volume!r} AS released
  FROM lined WHERE place = 1
  UNION ALL
  SELECT n.depot, n.lane, n.place, p.release + CAST(p.released AS BIGINT), n.w, n.v,
         CASE WHEN p.released THEN n.w ELSE p.w + n.w END, CASE WHEN p.released THEN n.v ELSE p.v + n.v END,
         CASE WHEN p.released THEN n.w ELSE p.w + n.w END >= {registry.FLUSH.weight!r}
           OR CASE WHEN p.released THEN n.v ELSE p.v + n.v END >= {registry.FLUSH.volume!r}
  FROM walk p JOIN lined n ON n.depot = p.depot AND n.lane = p.lane AND n.place = p.place + 1)
SELECT depot AS key, lane, release, count(*) AS orders, sum(own_w) AS weight, sum(own_v) AS volume
FROM walk GROUP BY depot, lane, release HAVING bool_or(released)""",
    "stream_cutoff_flush": f"""WITH {ORDERS},
fed AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '{registry.FEED_DAYS[0]}' THEN 0 WHEN ts < TIMESTAMP '{registry.FEED_DAYS[1]}' THEN 1
            ELSE 2 END AS part
  FROM paid)
SELECT depot AS key, CAST(part AS BIGINT) AS release, count(*) AS orders, sum(total_weight) AS weight,
  sum(total_volume) AS volume, 'full' AS buffer
FROM fed GROUP BY depot, part
UNION ALL
SELECT depot, CAST(0 AS BIGINT), count(*), sum(total_weight), sum(total_volume), 'never_full' FROM fed GROUP BY depot""",
    "stream_publish": f"""WITH {ORDERS}
SELECT customer_id AS key, order_id, total_weight, total_price, {stamp('ts', 'order_timestamp')} FROM plain""",
}

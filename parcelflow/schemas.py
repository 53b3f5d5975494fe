"""Row shapes of the order and solution tables, as DDL text that every reader takes."""

from __future__ import annotations

# Field names and types of the event and table layouts.
_ADDRESS = """struct<
  address_id: string, neighborhood: string, coordinates: array<double>, road: string, house_number: string,
  suburb: string, city_district: string, state: string, postcode: string, country: string,
  lat: double, lon: double>"""
_ITEM = """struct<
  product_id: string, product_name: string, price: double, quantity: int,
  packages: array<struct<package_id: string, subpackage_id: int, quantity: int, weight: double, volume: double>>>"""
_PAYMENT = "struct<payment_method: string, payment_status: string, transaction_id: string>"
_STOP = "struct<location_id: string, location_name: string, arrival_time: string, finish_time: string, distance: double>"

EVENT = f"""
  event_id string, event_type string, event_timestamp string, order_id string,
  order_details struct<
    customer_id: string, order_timestamp: string, order_date: string, items: array<{_ITEM}>,
    total_amount: double, total_volume: double, total_weight: double, status: string,
    destination_address: {_ADDRESS}, payment_details: {_PAYMENT}>
"""

FLAT_ORDER = """
  order_id string, customer_id string, total_weight double, total_volume double, total_price double,
  order_timestamp timestamp, status string, lat double, lon double
"""

GOLD_ORDER = """
  order_id string, customer_id string, total_weight double, total_volume double, total_price double,
  order_timestamp timestamp, status string, lat double, lon double, depot string, hour timestamp
"""

SIMPLE_ORDER = """
  client_id bigint, location struct<address: string, lat: double, lon: double>, order_id string,
  order struct<n_objects: int, volume: double, weight: double>, status string, timestamp string
"""

CLIENT = "client_id bigint, address string, status string, points string, lat double, lon double"

# Drivers are map keys, so an idle or a new driver needs no schema change.
SOLUTION = f"""
  id string, status string, finished_at string, timing struct<finishedProcessingAt: string>,
  input string, region string,
  output struct<
    status: string, total_break_time: bigint, total_idle_time: bigint, total_travel_time: bigint,
    total_vehicle_overtime: bigint, total_visit_lateness: bigint, total_working_time: bigint,
    num_late_visits: bigint, num_unserved: bigint, total_distance: double, unserved: string,
    distances: map<string, double>, vehicle_overtime: map<string, bigint>,
    solution: map<string, array<{_STOP}>>,
    pl_precision: bigint, polylines: map<string, array<string>>>
"""

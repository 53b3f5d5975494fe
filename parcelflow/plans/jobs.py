"""The table-to-table jobs, end to end. Paths and formats are parameters; every job can be run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from parcelflow import config
from parcelflow.operators import packing, requests, solutions
from parcelflow.operators.orders import having_status
from parcelflow.schemas import SOLUTION
from parcelflow.sources import files, ledger, sinks, tables


def pack_orders(
    spark: SparkSession, ready_path: str, packed_path: str, limits: config.Limits = config.PACK_LIMITS
) -> None:
    """Number the batches of every hour. Packed hours are replaced, so a second run adds no copies."""
    rows = tables.with_row_identity(tables.read_table(spark, ready_path))
    packed = packing.capacity_batches(rows, "hour", limits, (*packing.FIFO, "row_identity"))
    sinks.overwrite_partitions(packed.drop("row_identity"), packed_path, ["hour"])


def request_batches(
    spark: SparkSession,
    packed_path: str,
    request_path: str,
    settings: config.Settings = config.Settings(),
    keys: Sequence[str] = ("hour", "batch_id"),
) -> None:
    """One request document per batch, as a table with the keys next to the text."""
    ready = having_status(tables.read_table(spark, packed_path), config.READY_FOR_DISPATCH)
    sinks.overwrite(requests.request_documents(ready, keys, settings), request_path)


def load_solutions(spark: SparkSession, answers_path: str, table_path: str, multi_line: bool = True) -> None:
    """Answers by dispatch hour. Earlier answers stay, a repeated load adds none, a corrected answer replaces its older self."""
    answers = files.read_documents(spark, answers_path, SOLUTION, multi_line)
    ledger.load(solutions.with_dispatch_times(answers), table_path, "dispatched_hour")


def build_report_table(spark: SparkSession, table_path: str, report_path: str) -> None:
    sinks.overwrite(solutions.report_rows(tables.read_table(spark, table_path)), report_path, ["finished_at"])


def archive_routes(spark: SparkSession, table_path: str, archive_path: str) -> None:
    sinks.overwrite(solutions.route_archive(tables.read_table(spark, table_path)), archive_path)


def load_by_date(spark: SparkSession, answers: DataFrame, bronze_path: str, silver_path: str, lines_path: str) -> None:
    """Older layout: raw answers by next day, chosen columns by day, drawing lines by run.

    Every table keeps the answers of earlier loads; repeated ones add nothing and corrected ones replace their older selves.
    """
    ledger.load(solutions.next_day_partition(answers), bronze_path, "dispatched_date")
    silver = solutions.same_day_partition(answers)
    ledger.load(silver, silver_path, "dispatched_date")
    ledger.load(solutions.route_lines(silver), lines_path, "finished_at_clean", version="finished_at_clean")


def dispatch_served(spark: SparkSession, orders_path: str, answers: DataFrame, root: str, as_of: Column) -> str:
    """Mark the orders of served customers in a new version of the order table; returns its path."""
    rows = tables.read_table(spark, orders_path)
    marked = solutions.mark_dispatched(rows, solutions.served_customers(answers, as_of))
    return sinks.new_version(marked, root)


def catalog_report(spark: SparkSession, database: str, name: str, report_path: str) -> str:
    """Database and external table over the report files, partitions found; returns the table's name."""
    sinks.create_database(spark, database)
    schema = tables.read_table(spark, report_path).schema
    full = f"{database}.{name}"
    sinks.create_external_table(spark, full, schema, report_path, ["finished_at"])
    sinks.discover_partitions(spark, full)
    return full

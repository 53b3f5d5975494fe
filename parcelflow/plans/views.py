"""Views for reporting tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.text import identifier
from parcelflow.operators.solutions import driver_stops, run_summary


def create_report_views(solutions: DataFrame) -> None:
    driver_stops(solutions).createOrReplaceTempView("driver_solutions")
    run_summary(solutions).createOrReplaceTempView("dispatched_orders_flat")


def run_views(table: DataFrame, prefix: str = "dispatched_orders_") -> DataFrame:
    """View name, finish time and row count of every run."""
    return table.groupBy("finished_at").agg(F.count("*").alias("runs")).select(
        F.concat(F.lit(prefix), identifier(F.col("finished_at"))).alias("view_name"), "finished_at", "runs"
    )


def create_run_view(table: DataFrame, finished_at: str, prefix: str = "dispatched_orders_") -> str:
    """View of one run, made when it is wanted; on a table partitioned by ``finished_at`` it reads only its own folder."""
    name = run_views(table.sparkSession.createDataFrame([(finished_at,)], "finished_at string"), prefix).first()["view_name"]
    run_view(table, finished_at).createOrReplaceTempView(name)
    return name


def run_view(table: DataFrame, finished_at: str) -> DataFrame:
    return table.filter(F.col("finished_at") == finished_at)


def query_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

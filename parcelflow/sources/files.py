"""Reading documents and folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.text import path_element
from parcelflow.schemas import CLIENT
from parcelflow.sources.tables import Schema


def read_documents(
    spark: SparkSession, path: str, schema: Schema | None = None, multi_line: bool = True
) -> DataFrame:
    """JSON documents, one (or one array of them) per file; without ``schema`` it is inferred.

    ``multi_line=False`` reads one document per line, which Spark can split inside a file.
    """
    reader = spark.read.option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_clients(spark: SparkSession, path: str, schema: Schema = CLIENT) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def folder_jobs(spark: SparkSession, path: str, depth: int = -2) -> DataFrame:
    """Distinct job folders below ``path``; files are listed, not opened. ``job_id=j1`` is job ``j1``."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.regexp_replace(path_element(F.col("path"), depth), "^[^=]*=", "").alias("job_id"))
    )
    return listed.distinct()


def pending_jobs(requested: DataFrame, finished: DataFrame) -> DataFrame:
    """Requested jobs that have no answer yet."""
    return requested.select("job_id").distinct().join(finished.select("job_id"), "job_id", "left_anti")

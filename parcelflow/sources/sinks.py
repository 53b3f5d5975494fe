"""Writing tables, and keeping them tidy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.sources.tables import read_table, table_exists


#: Folders that one write fills before its tasks are kept apart.
MANY_FOLDERS = 100
_MERGED = "spark.sql.adaptive.coalescePartitions.enabled"


@contextmanager
def spread(spark: SparkSession, folders: int) -> Iterator[None]:
    """Writes inside fill so many folders. If they are many, tasks aren't merged by bytes: few would make all the small files."""
    before = spark.conf.get(_MERGED, "true")
    if folders > MANY_FOLDERS:
        spark.conf.set(_MERGED, "false")
    try:
        yield
    finally:
        spark.conf.set(_MERGED, before)


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of an output partition together, in tasks of even size.

    The rebalance hint lets adaptive execution split a partition value that holds much of the
    data and merge tiny ones, so neither one task nor thousands of small files result.
    """
    return df.hint("rebalance", *[F.col(name) for name in by]) if by else df.hint("rebalance")


def append(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append, creating the table if it is missing."""
    (gathered(df, by) if by else df).write.format(fmt).mode("append").partitionBy(*by).save(path)


def overwrite(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    (gathered(df, by) if by else df).write.format(fmt).mode("overwrite").partitionBy(*by).save(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` has rows for, so that a job can be run again."""
    writer = gathered(df, by).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).save(path)


def write_once(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write unless the table exists already."""
    gathered(df, by).write.format(fmt).mode("ignore").partitionBy(*by).save(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_documents(
    df: DataFrame, path: str, by: Sequence[str] = ("job_id",), column: str = "document", compression: str = "gzip"
) -> None:
    """JSON texts as lines below one folder per ``by`` value; plain, they take many times the disk of the table they come from."""
    gathered(df.select(*by, column), by).write.mode("append").partitionBy(*by).text(path, compression=compression)


def write_payloads(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Rows as JSON payload lines, the events that :func:`parcelflow.sources.tables.read_json_events` takes."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(path, compression=compression)


def new_version(df: DataFrame, root: str, by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Write ``df`` as a new version below ``root`` and return its path.

    A plain file table cannot be overwritten while it is being read; readers keep the old version
    until they are handed the new path.
    """
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    overwrite(df, path, by, fmt)
    return path


def compacted(spark: SparkSession, path: str, root: str, by: Sequence[str] = (), files: int | None = None) -> str:
    """Rewrite many small files as few large ones: about ``files`` of them, or by Spark's target size."""
    rows = read_table(spark, path)
    if files is not None:
        rows = rows.coalesce(files)
    elif not by:
        rows = gathered(rows, by)
    return new_version(rows, root, by)


def updated(target: DataFrame, changes: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """``target`` with ``values`` set on rows that have a match in ``changes``; other rows stay as they are.

    ``changes`` holds at most one row per key. ``values`` may use columns of both sides.
    """
    marked = changes.withColumn("_matched", F.lit(True))
    joined = target.join(marked, list(keys), "left")
    columns = [
        F.when(F.col("_matched"), values[name]).otherwise(target[name]).alias(name) if name in values else target[name]
        for name in target.columns
    ]
    return joined.select(*columns)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, path: str, by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """External table over files that exist already; its partitions still have to be discovered.

    A table of that name over other files is an error, not taken for the one wanted.
    """
    if table_exists(spark, name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
        place = rows[0]["data_type"].rstrip("/") if rows else ""
        if not place.endswith(path.split(":", 1)[-1].rstrip("/")):
            raise ValueError(f"{name} exists already over {place}, not {path}")
        return
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    partitions = f" PARTITIONED BY ({', '.join(by)})" if by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{partitions} LOCATION '{path}'")


def discover_partitions(spark: SparkSession, name: str) -> None:
    spark.catalog.recoverPartitions(name)


def keyed_records(df: DataFrame, key: str) -> DataFrame:
    """Rows as key and JSON value, the shape log sinks take; batch or stream."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))

"""Reading tables, batch and stream. The format is a parameter; Parquet is the default."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Schema = StructType | str


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: Schema | None = None, **options: str
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table whose files gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_stream(
    spark: SparkSession,
    path: str | None,
    schema: Schema | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Table, folder or log as a stream.

    ``fmt`` and ``options`` pass through to any installed connector (start position, region, topic, ...);
    sources with a schema of their own take no ``schema``. ``max_files`` bounds one micro-batch of a file source.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path) if path else reader.load()


def read_rewritten_stream(spark: SparkSession, path: str, schema: Schema, fmt: str = "parquet") -> DataFrame:
    """Stream over a table whose old files may be rewritten or deleted.

    A file source never reads a seen file twice and may skip files that are gone; a table format
    that tracks changes gets the two switches with the same meaning.
    """
    if fmt == "delta":
        return read_stream(spark, path, fmt=fmt, ignoreDeletes="true", ignoreChanges="true")
    return read_stream(spark, path, schema, fmt, ignoreMissingFiles="true")


def read_stream_from(
    spark: SparkSession, path: str, schema: Schema, start: str = "earliest", fmt: str = "parquet", **options: str
) -> DataFrame:
    """File stream from the ``earliest`` file on, with the ``latest`` files first, or from a time on.

    With a bounded ``maxFilesPerTrigger`` the second form serves fresh orders before the backlog. A time such as
    ``2024-10-01 12:00:00`` (UTC) leaves out the rows of files written before it, the backlog; :func:`written_until`
    gives that of now. A stream that is started again must be given the same time.
    """
    if start in ("earliest", "latest"):
        return read_stream(spark, path, schema, fmt, latestFirst=str(start == "latest").lower(), **options)
    try:
        since = datetime.fromisoformat(start)
    except ValueError:
        raise ValueError(f"start must be 'earliest', 'latest' or a time, not {start!r}") from None
    stream = read_stream(spark, path, schema, fmt, **options)
    return stream.filter(F.col("_metadata.file_modification_time") > F.lit(since.isoformat(" ")).cast("timestamp"))


def written_until(spark: SparkSession, path: str) -> str:
    """When the newest file of a table was written (UTC); a stream from there on begins with what comes next."""
    newest = spark.read.parquet(path).agg(F.date_format(F.max("_metadata.file_modification_time"), "yyyy-MM-dd HH:mm:ss.SSS"))
    return newest.first()[0]


def read_json_events(
    spark: SparkSession, path: str, schema: Schema, max_files: int | None = None
) -> DataFrame:
    """Stream of JSON payload lines as typed rows; a broken payload gives a row of NULLs."""
    lines = read_stream(spark, path, StructType().add("value", "string"), "text", max_files)
    return lines.select(F.from_json("value", schema).alias("event")).select("event.*")


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Whether a catalog table, or a path on any Hadoop file system, exists."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    path = spark._jvm.org.apache.hadoop.fs.Path(name_or_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def with_row_identity(df: DataFrame, name: str = "row_identity") -> DataFrame:
    """Add a column that tells even equal rows of a Parquet table apart: file (as a hash) and position in it."""
    return df.withColumn(name, F.struct(F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")))


def read_archiving_stream(
    spark: SparkSession, path: str, schema: Schema, archive: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """File stream that moves each input to ``archive`` once a later micro-batch shows it is done with."""
    return read_stream(spark, path, schema, fmt, cleanSource="archive", sourceArchiveDir=archive, **options)

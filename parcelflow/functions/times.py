"""Time expressions. All of them give NULL, never an error, on text that does not parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the tables.
ORDER_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOUR_FORMAT = "yy-MM-dd-HH"
HALF_HOUR_FORMAT = "yyyy-MM-dd-HH-mm"
FILE_FORMAT = "yyyy-MM-dd_HH-mm-ss"


def parsed(text: Column, pattern: str = ORDER_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def parsed_iso(text: Column) -> Column:
    return text.try_cast("timestamp")


def hour_start(at: Column) -> Column:
    return F.date_trunc("hour", at)


def hour_label(at: Column) -> Column:
    return F.date_format(at, HOUR_FORMAT)


def file_label(at: Column) -> Column:
    return F.date_format(at, FILE_FORMAT)


def half_hour_label(text: Column, missing: str) -> Column:
    """Nearest half hour of an ISO time as text; ``missing`` where there is no time at all."""
    half_hours = F.round(F.unix_seconds(parsed_iso(text)) / F.lit(1800)).cast("bigint")
    label = F.date_format(F.timestamp_seconds(half_hours * F.lit(1800)), HALF_HOUR_FORMAT)
    return F.when(text.isNull(), F.lit(missing)).otherwise(label)


def day(at: Column) -> Column:
    return F.to_date(at)


def next_day(at: Column) -> Column:
    return F.date_add(F.to_date(at), 1)


def clock_on_next_day(as_of: Column, clock: Column) -> Column:
    """Timestamp of an ``HH:MM`` clock reading on the day after ``as_of``."""
    return F.try_to_timestamp(
        F.concat_ws(" ", F.date_add(as_of, 1).cast("string"), clock), F.lit("yyyy-MM-dd H:m")
    )

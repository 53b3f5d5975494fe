"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier(text: Column) -> Column:
    """Text usable in a view name."""
    return F.translate(text, "-:.", "___")


def file_safe(text: Column) -> Column:
    return F.regexp_replace(text, r"[:\s]", "-")


def path_element(path: Column, position: int) -> Column:
    """Element of a path; negative positions count from the end."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))

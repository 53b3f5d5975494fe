"""Struct reshaping."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def leaf_paths(schema: StructType, parents: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of all fields that are not structs themselves; arrays and maps count as leaves."""
    for name, kind in ((field.name, field.dataType) for field in schema.fields):
        if isinstance(kind, StructType):
            yield from leaf_paths(kind, (*parents, name))
        else:
            yield (*parents, name)


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Every nested struct field as a column of its own: ``a.b`` becomes ``a_b``."""
    return df.select(
        *[
            F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path))
            for path in leaf_paths(df.schema)
        ]
    )


def unnest(df: DataFrame, struct: str, exclude: Collection[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Fields of one struct as ``<struct>_<field>`` columns, next to the columns to keep."""
    fields = [name for name in df.schema[struct].dataType.names if name not in exclude]
    return df.select(*[F.col(f"{struct}.{name}").alias(f"{struct}_{name}") for name in fields], *keep)


def drop_fields(df: DataFrame, struct: str, *fields: str) -> DataFrame:
    return df.withColumn(struct, F.col(struct).dropFields(*fields))


def typed_location(location: Column) -> Column:
    """Location given as a map of texts as a struct with numbers."""
    return F.struct(
        location["address"].alias("address"),
        location["lat"].try_cast("double").alias("lat"),
        location["lon"].try_cast("double").alias("lon"),
    )

"""Work on rows in a total order without putting a whole group into one task.

A group (an hour, a depot) may hold a large part of all rows. As long as the largest group is
small, one shuffle by group is the cheapest plan. Beyond that the rows are range-partitioned over
group *and* order, which cuts large groups into slices of even size, and totals are carried from
slice to slice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import checkpointed, stored

# Rows of one group that a single task sorts and walks comfortably. It decides on the plan only: sums are exact.
GROUP_LIMIT = 2_000_000
# Loads are added as decimals of this type, so the order in which slices are added up can't change a sum.
EXACT = "decimal(20,6)"


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of all groups; only key columns are read, only two numbers come back."""
    sizes = df.groupBy(*keys).count()
    largest, rows = sizes.agg(F.max("count"), F.sum("count")).first()
    return largest or 0, rows or 0


def slices_for(rows: int) -> int:
    """Slices no larger, on average, than a group that one task may hold."""
    return max(1, -(-rows // GROUP_LIMIT))


def group_key(keys: Sequence[str]) -> Column:
    """Text that is the same for, and only for, rows of one group; never NULL."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def key_runs(keys: pa.Array) -> Iterator[tuple[str, int, int]]:
    """Stretches of equal values in sorted, non-empty ``keys``, as key, start and end."""
    changes = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False).nonzero()[0]
    borders = [0, *(changes + 1).tolist(), len(keys)]
    for start, end in zip(borders, borders[1:], strict=False):
        yield keys[start].as_py(), start, end


def numbers_of(batch: pa.RecordBatch | pa.Table, name: str) -> list[float]:
    """A number column as Python numbers, NULL as nothing."""
    return pc.fill_null(batch.column(name), 0).to_pylist()


def with_result(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch without its working columns, those that start with ``_``, and with one new column."""
    kept = [column for column in batch.schema.names if not column.startswith("_")]
    return pa.RecordBatch.from_arrays([*(batch.column(column) for column in kept), values], names=[*kept, name])


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int) -> DataFrame:
    ranged = df.repartitionByRange(slices, *[F.col(name) for name in (*keys, *order)])
    return ranged.withColumn("_slice", F.spark_partition_id().cast("bigint"))


def stored_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int) -> DataFrame:
    """Rows with the number of their slice, stored: range borders are sampled, so they must be cut once only."""
    return stored(_cut(df, keys, order, slices), "slices")


def sorted_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int) -> DataFrame:
    """Like :func:`stored_slices`, but every partition *is* a slice, with its rows in order."""
    return checkpointed(_cut(df, keys, order, slices).sortWithinPartitions(*keys, *order))


def exact(total: Column) -> Column:
    """A sum of ``EXACT`` values in the one type that all plans give."""
    return total.cast("decimal(30,6)")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, str],
    group_limit: int = GROUP_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums, ``{new column: summed column}``, per group in the given order, as decimals.

    Values are rounded to six decimals and added exactly, so any number of slices gives the same sums.

    ``order`` should tell all rows of a group apart. Rows equal in it stay in one slice; for tables
    with many equal copies append :func:`parcelflow.sources.tables.with_row_identity`.
    """
    largest, rows = group_sizes(df, keys) if slices is None else (None, 0)
    if largest is not None and largest <= group_limit:
        so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({name: exact(F.sum(F.col(value).cast(EXACT)).over(so_far)) for name, value in totals.items()})

    # The group as one struct: equal to itself even where a key is NULL, so the join below keeps such rows.
    cut = stored_slices(df, keys, order, slices or slices_for(rows)).withColumn("_group", F.struct(*keys))
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy("_group", "_slice")
        .agg(*[F.sum(F.col(value).cast(EXACT)).alias(f"_sum_{name}") for name, value in totals.items()])
        .select("_group", "_slice", *[F.sum(f"_sum_{name}").over(earlier).alias(f"_carry_{name}") for name in totals])
    )
    inside = Window.partitionBy("_group", "_slice").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_local_{name}": F.sum(F.col(value).cast(EXACT)).over(inside) for name, value in totals.items()})
    whole = local.join(carried, ["_group", "_slice"])
    # A sum over NULLs only is NULL, as it is in the one-task form.
    sums = [
        F.when(
            F.col(f"_local_{name}").isNotNull() | F.col(f"_carry_{name}").isNotNull(),
            exact(F.coalesce(F.col(f"_local_{name}"), F.lit(0)) + F.coalesce(F.col(f"_carry_{name}"), F.lit(0))),
        ).alias(name)
        for name in totals
    ]
    return whole.select(*df.columns, *sums)

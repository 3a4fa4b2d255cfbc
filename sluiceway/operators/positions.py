"""Numbering rows in order, over everything or inside each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.operators.joins import lookup
from sluiceway.session import write_once

# monotonically_increasing_id() puts the row's index inside its partition in
# the low 33 bits and the partition's number above them.
_INDEX_BITS = 33

# Rows that one task sorts, about: ranges are as many as the rows need.
ROWS_PER_RANGE = 500_000


def numbered_ranges(df: DataFrame, by: Sequence[Column], ranges: int, run: str = "") -> DataFrame:
    """Written copy of ``df`` in sorted ranges: ``__row`` rises with the order,
    by one inside each range, whose number is ``__part``.

    ``df`` is read twice, to sample the ranges and to sort, so it should be written.
    """
    numbered = (
        df.repartitionByRange(ranges, *by)
        .sortWithinPartitions(*by)
        .withColumn("__row", F.monotonically_increasing_id())
    )
    return write_once(numbered, "positions", run).withColumn(
        "__part", F.shiftright("__row", _INDEX_BITS)
    )


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "pos",
    rows_per_range: int | None = None,
    run: str = "",
) -> DataFrame:
    """Add each row's 1-based position in ``order`` within its ``keys``.

    ``df`` should be written and narrow. Its rows are counted; those that fit in one
    range are numbered by a window. Otherwise a single key may hold a large share of
    all rows, and one task must not sort it alone: rows are split by range of
    ``(keys, order)``, so a hot key spans many partitions; each is numbered by itself
    and written once; then the offset of every (key, partition) run, one small row
    each, is added.

    The order has to be total for repeated runs to agree.
    """
    ranges = -(-df.count() // (rows_per_range or ROWS_PER_RANGE))
    if ranges <= 1:
        ranking = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(ranking).cast("bigint"))

    by = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    placed = numbered_ranges(df, by, ranges, run)
    runs = placed.groupBy(*keys, "__part").agg(
        F.min("__row").alias("__start"), F.count("*").alias("__n")
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("__part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    offsets = runs.select(
        *[F.col(k).alias(f"run_{k}") for k in keys],
        F.col("__part").alias("run_part"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__start") + 1).alias("__shift"),
    )
    on = {k: f"run_{k}" for k in keys} | {"__part": "run_part"}
    return (
        lookup(placed, offsets, on, null_safe=True)
        .withColumn(name, F.col("__row") + F.col("__shift"))
        .drop("__row", "__part", "__shift")
    )

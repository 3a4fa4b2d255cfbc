"""Places and running sums in one total order, from per-block totals (DataFrame functions only).

Rows are range-partitioned by (keys, order, a row number) into blocks, so a key that holds a
third of all rows spans many blocks and no block is larger than its share. Each block's
count and sums per key make one small row; a window over those rows gives what lies before
each block, and a window inside each (block, key) adds what lies before the row there. The
row number only breaks ties between repeated rows, whose places may then come in any order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column] = {},
    blocks: int | None = None,
    run: str = "",
) -> DataFrame:
    """``df`` with ``pos`` (0-based place inside its ``keys`` by ``order``) and, for each
    name of ``sums``, ``<name>_before`` (the sum over earlier rows of its keys) and
    ``<name>_all`` (over all rows of its keys).

    ``df`` should be narrow; its columns must not start with ``_p_``. Null keys are one
    key; ``order`` states where nulls go. ``blocks`` (default: shuffle partitions) is the
    number of ranges; totals travel as one row per block and key. Empty input: no rows.
    """
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc_nulls_first() for k in keys] + list(order) + [F.col("_p_uid")]
    named = {f"_p_w_{name}": value for name, value in sums.items()}
    ranged = write_once(
        df.select("*", *[value.cast("long").alias(name) for name, value in named.items()],
                  F.monotonically_increasing_id().alias("_p_uid"))
        .repartitionByRange(blocks, *by)
        .withColumn("_p_block", F.spark_partition_id()),
        "prefix",
        run,
    )
    totals = ranged.groupBy("_p_block", *keys).agg(
        F.count("*").alias("_p_rows"), *[F.sum(name).alias(f"{name}_t") for name in named]
    )
    earlier = Window.partitionBy(*keys).orderBy("_p_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        F.col("_p_block").alias("_p_ob"),
        *[F.col(k).alias(f"_p_k_{k}") for k in keys],
        F.coalesce(F.sum("_p_rows").over(earlier), F.lit(0)).alias("_p_rows_before"),
        *[F.coalesce(F.sum(f"{name}_t").over(earlier), F.lit(0)).alias(f"{name}_b") for name in named],
        *[F.sum(f"{name}_t").over(whole).alias(f"{name}_a") for name in named],
    )
    if not keys:  # one row per block: a bound set by a parameter
        offsets = F.broadcast(offsets)
    on = [ranged["_p_block"] == offsets["_p_ob"]] + [ranged[k].eqNullSafe(offsets[f"_p_k_{k}"]) for k in keys]
    inside = Window.partitionBy("_p_block", *keys).orderBy(*by)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(offsets, reduce(and_, on)).select(  # on _p_block and keys, as the window is
        *[ranged[c] for c in df.columns],
        (F.col("_p_rows_before") + F.row_number().over(inside) - 1).alias("pos"),
        *[(F.col(f"{name}_b") + F.sum(name).over(upto) - F.col(name)).alias(f"{name[5:]}_before") for name in named],
        *[F.col(f"{name}_a").alias(f"{name[5:]}_all") for name in named],
    )
    return placed

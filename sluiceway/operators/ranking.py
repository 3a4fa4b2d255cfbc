"""First rows per key, with explicit null order and full tie-breaks.

``row_number() <= k`` filters get Spark's partial top-k (WindowGroupLimit), so
each map task sends at most k rows per key and a hot key stays cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.expressions import join_names
from sluiceway.functions.predicates import not_deleted


def first_rows(df: DataFrame, keys: list[str], order: list, k: int, name: str = "rn") -> DataFrame:
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ranking)).filter(F.col(name) <= k)


def current_module(modules: DataFrame) -> DataFrame:
    """Latest current module of each project that is not deleted."""
    live = not_deleted(
        modules.filter(F.col("current_module") & (F.col("current_previous") == "Current"))
    )
    order = [F.col("updated_at").desc_nulls_first(), F.col("id").asc_nulls_last()]
    return first_rows(live, ["project_id"], order, 1).select(
        "project_id", "module_name", "module_number"
    )


def participants(farmers: DataFrame) -> DataFrame:
    """Names of the first two members per household, as one text.

    Primary members come first and unknown before known, as do later updates.
    """
    order = [
        F.col("is_primary_household_member").desc_nulls_first(),
        F.col("updated_at").desc_nulls_first(),
        F.col("id").asc_nulls_last(),
    ]
    top = first_rows(not_deleted(farmers), ["household_id"], order, 2)
    named = top.groupBy("household_id").agg(
        F.max("rn").alias("n"),
        F.max(F.when(F.col("rn") == 1, F.col("first_name"))).alias("first"),
        F.max(F.when(F.col("rn") == 2, F.col("first_name"))).alias("second"),
    )
    return named.select(
        "household_id", join_names("n", "first", "second").alias("household_participants")
    )


def module_info(modules: DataFrame) -> DataFrame:
    """First ``Current`` and first ``Previous`` module per project, deleted or not.

    Which one is first is not defined by the contract; the lowest
    ``(module_number, id)`` is taken so that a repeated run agrees.
    """
    state = F.col("current_previous")
    order = [F.col("module_number").asc_nulls_last(), F.col("id").asc_nulls_last()]
    firsts = first_rows(
        modules.filter(state.isin("Current", "Previous")),
        ["project_id", "current_previous"],
        order,
        1,
    )

    def of(which: str, column: str):
        return F.max(F.when(state == which, F.col(column)))

    return firsts.groupBy("project_id").agg(
        of("Current", "module_number").alias("current_number"),
        of("Current", "module_name").alias("current_name"),
        of("Previous", "module_number").alias("previous_number"),
        of("Previous", "module_name").alias("previous_name"),
    )


def group_first_row(df: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` of the first row of each group in ``(updated_at, id)`` order.

    A plain aggregate: every task sends one candidate per group.
    """
    order = F.struct(F.col("updated_at").isNull(), F.col("updated_at"), F.col("id"))
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))

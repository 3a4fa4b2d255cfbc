"""Counts: what is waiting, and what a run did."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.predicates import pending
from sluiceway.operators.packaging import KEY
from sluiceway.operators.settlement import accepted
from sluiceway.operators.joins import lookup


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def count_pending(df: DataFrame) -> DataFrame:
    return pending(df).agg(F.count("*").alias("pending"))


def count_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Pending records per outbox table."""
    return union_all(
        count_pending(df).select(F.lit(name).alias("entity"), "pending")
        for name, df in tables.items()
    )


def group_sizes(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows per group; rows without a key form a group of their own."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows"))


def run_report(members: DataFrame, receipts: DataFrame, entity: str) -> DataFrame:
    """One row: rows picked, rows in accepted documents, and number of groups.

    Members are counted per document first, so that only small rows meet the
    receipts.
    """
    per_document = members.groupBy(KEY, "payload_id").agg(F.count("*").alias("n"))
    judged = lookup(per_document, accepted(receipts), {"payload_id": "payload_id"}, "left")
    per_group = judged.groupBy(KEY).agg(
        F.sum("n").alias("picked"), F.sum(F.when(F.col("ok"), F.col("n"))).alias("sent")
    )
    return per_group.agg(
        F.lit(entity).alias("entity"),
        F.coalesce(F.sum("picked"), F.lit(0)).alias("picked"),
        F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"),
        F.count("*").alias("groups"),
    )


def run_totals(reports: DataFrame) -> DataFrame:
    return reports.agg(
        F.coalesce(F.sum("picked"), F.lit(0)).alias("picked"),
        F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"),
    )

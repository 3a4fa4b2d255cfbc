"""Per-key aggregates, each combined on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.predicates import not_deleted
from sluiceway.operators.joins import lookup


def child_count(
    df: DataFrame, child: DataFrame, fk: str, name: str, key: str = "id", dtype: str = "bigint"
) -> DataFrame:
    """Number of ``child`` rows per row of ``df``, 0 when there is none.

    Filter ``child`` first to count only some of its rows.
    """
    counts = child.groupBy(fk).agg(F.count("*").alias(name))
    counted = lookup(df, counts, {key: fk}, "left")
    return counted.withColumn(name, F.coalesce(name, F.lit(0)).cast(dtype))


def latest_by_type(
    visits: DataFrame,
    responses: DataFrame,
    response_dated: Sequence[str],
    visit_dated: Sequence[str],
) -> DataFrame:
    """One row per ``wetmill_id`` with the latest date of each survey type.

    ``response_dated`` types take the response's own date, ``visit_dated`` types
    the date of the visit that has such a response. Deleted visits do not count.

    Responses are first reduced to one row per visit, so a visit or mill with
    very many responses is combined on the map side, the join is one to one,
    and each fact table is scanned and exchanged once for all types together.
    """
    kind = F.col("survey_type")
    per_visit = (
        responses.filter(kind.isin(*response_dated, *visit_dated))
        .groupBy("form_visit_id")
        .agg(
            *[F.max(F.when(kind == t, F.col("completed_date"))).alias(t) for t in response_dated],
            *[F.max(kind == t).alias(t) for t in visit_dated],
        )
    )
    kept = not_deleted(visits).select("id", "wetmill_id", "visit_date")
    dated = lookup(kept, per_visit, {"id": "form_visit_id"})
    return dated.groupBy("wetmill_id").agg(
        *[F.max(t).alias(f"{t}_date") for t in response_dated],
        *[F.max(F.when(F.col(t), F.col("visit_date"))).alias(f"{t}_date") for t in visit_dated],
    )

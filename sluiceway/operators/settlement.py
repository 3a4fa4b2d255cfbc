"""Settling records by the receipts of their documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.claim import state_changes
from sluiceway.operators.joins import lookup
from sluiceway.schemas import COMPLETE

# Fixed value: the status code of an accepted document.
ACCEPTED = 200


def accepted(receipts: DataFrame) -> DataFrame:
    """One row per delivered document: was any attempt accepted?"""
    ok = F.coalesce(F.col("status_code") == ACCEPTED, F.lit(False))
    return receipts.groupBy("payload_id").agg(F.max(ok).alias("ok"))


def outcomes(members: DataFrame, receipts: DataFrame) -> DataFrame:
    """Members with ``ok``: true, false, or null while no receipt has come."""
    return lookup(members, accepted(receipts), {"payload_id": "payload_id"}, "left")


def settle(
    members: DataFrame,
    receipts: DataFrame,
    *,
    entity: str,
    on_fail: str,
    run_id: str,
    run_ts: datetime | str,
    run_seq: int | None = None,
) -> DataFrame:
    """State changes the receipts call for.

    A record is complete when every document that carries it was accepted; it
    goes to ``on_fail`` when one was refused; without a receipt it stays as it is.
    """
    per_record = (
        outcomes(members, receipts)
        .groupBy("id")
        .agg(F.min("ok").alias("all_ok"), F.max(F.col("ok").isNull()).alias("waiting"))
    )
    verdict = F.when(~F.col("all_ok"), F.lit(on_fail)).when(
        F.col("all_ok") & ~F.col("waiting"), F.lit(COMPLETE)
    )
    settled = per_record.withColumn("verdict", verdict).filter(F.col("verdict").isNotNull())
    return state_changes(settled, entity, F.col("verdict"), run_id, run_ts, step=1, run_seq=run_seq)

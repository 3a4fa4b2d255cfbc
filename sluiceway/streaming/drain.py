"""Draining newly eligible records with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.ranking import first_rows
from sluiceway.plans.enrichment import Tables
from sluiceway.plans.entities import MAX_ITEMS, EntitySpec
from sluiceway.plans.runs import dispatch, spec_of
from sluiceway.schemas import UPDATED
from sluiceway.sources.sinks import append_changes


def newest(records: DataFrame) -> DataFrame:
    """Latest version of each record in a batch of appended versions."""
    order = [F.col(UPDATED).desc_nulls_last(), F.xxhash64(F.struct("*")).asc()]
    return first_rows(records, ["id"], order, 1).drop("rn")


def drain_stream(
    records: DataFrame,
    tables: Tables | Callable[[], Tables],
    entity: EntitySpec | str,
    path: str,
    checkpoint: str,
    *,
    run_ts: datetime | str,
    name: str = "drain",
    max_items: int = MAX_ITEMS,
) -> StreamingQuery:
    """Package what was appended to ``records`` since the last drain, then stop.

    ``records`` is a streaming read of an append-only table of outbox rows: a
    record that is flagged again is appended again. Each trigger claims the
    eligible rows of its batch and writes their documents and state changes
    under ``path``. Batches are numbered by the stream's checkpoint and ids
    derive from that number, so a batch repeated after a failure replaces its
    own output with the same.
    """
    spec = spec_of(entity)

    def package_batch(batch: DataFrame, batch_id: int) -> None:
        sent = dispatch(
            tables() if callable(tables) else tables,
            spec,
            state=newest(batch),
            run_id=f"{name}-{batch_id}",
            run_ts=run_ts,
            limit=None,
            max_items=max_items,
        )
        append_changes(sent.claim_changes(), f"{path}/changes")
        sent.documents.write.mode("overwrite").parquet(f"{path}/documents/batch={batch_id}")

    return (
        records.writeStream.queryName(name)
        .foreachBatch(package_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

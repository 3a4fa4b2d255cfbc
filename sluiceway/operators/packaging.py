"""Packaging enriched rows into nested JSON documents, one or more per group."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.expressions import doc_id, to_json_keep_nulls
from sluiceway.operators.joins import lookup
from sluiceway.operators.positions import with_positions
from sluiceway.session import write_once

KEY = "unique_project_key"

# Fixed values of the payload envelope.
SOURCE = "postgres"


@dataclass(frozen=True)
class Placed:
    """Written items, and where each stands: both have its reference ``ref``."""

    items: DataFrame  # ref, item
    positions: DataFrame  # ref, entity, id, unique_project_key, pos, chunk, payload_id

    def rows(self) -> DataFrame:
        """Every position with its item, which it has one of: readers of positions alone need no join."""
        return lookup(self.positions, self.items, {"ref": "ref"}, "left")


def place(
    enriched: DataFrame,
    *,
    entity: str,
    fields: dict[str, Column],
    order: list[str],
    run_id: str,
    max_items: int,
    packable: Column | None = None,
    key: str = "project_unique_id",
) -> Placed:
    """Give every row its item, its position in its group and its document.

    Positions follow the ``order`` columns, ascending with nulls last. A group is
    cut into documents of ``max_items`` positions; with ``max_items`` at least the
    group's size there is one document per group. Rows that are not packable keep
    a position and a document, so they settle with their group, but have a null
    item.

    The enriched rows are computed and written once; only the ordering columns and
    a reference are ranked.
    """
    item = F.struct(*[c.alias(name) for name, c in fields.items()])
    if packable is not None:
        item = F.when(packable, item)
    # The id is kept anyway.
    ranks = {name: name if name == "id" else f"__rank_{name}" for name in order}
    only = [rank for name, rank in ranks.items() if name != "id"]
    rows = enriched.select(
        "id",
        F.col(key).alias(KEY),
        item.alias("item"),
        *[F.col(name).alias(rank) for name, rank in ranks.items() if name != "id"],
        F.monotonically_increasing_id().alias("ref"),
    )
    written = write_once(rows, f"items-{entity}", run_id)
    by = [F.col(rank).asc_nulls_last() for rank in (*ranks.values(), "ref")]
    narrow = written.select("id", KEY, "ref", *only)
    placed = with_positions(narrow, [KEY], by, run=run_id).drop(*only)
    chunk = F.floor((F.col("pos") - 1) / F.lit(max_items)).cast("bigint")
    named = placed.withColumn("entity", F.lit(entity)).withColumn("chunk", chunk)
    positions = named.withColumn(
        "payload_id", doc_id("entity", F.lit(run_id), KEY, "chunk")
    )
    return Placed(
        written.select("ref", "item"), write_once(positions, f"positions-{entity}", run_id)
    )


def documents(
    placed: Placed, *, entity: str, job_type: str, items_field: str, run_id: str
) -> DataFrame:
    """One JSON document per group and chunk, items in position order.

    No task holds more than ``max_items`` items of a group, and the lists are
    already combined per task before the shuffle. A chunk without packable rows
    still yields a document, with an empty list.
    """
    entry = F.when(F.col("item").isNotNull(), F.struct("pos", "item"))
    grouped = placed.rows().groupBy(KEY, "chunk").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    payload_id = doc_id(F.lit(entity), F.lit(run_id), KEY, "chunk")
    body = F.struct(
        F.lit(SOURCE).alias("source"),
        F.lit(job_type).alias("jobType"),
        F.col(KEY).alias("uniqueProjectKey"),
        F.col("entries.item").alias(items_field),
        F.lit(entity).alias("entity"),
        payload_id.alias("id"),
    )
    return grouped.select(
        F.lit(entity).alias("entity"),
        F.lit(run_id).alias("run_id"),
        payload_id.alias("payload_id"),
        KEY,
        "chunk",
        F.size("entries").alias("n_items"),
        to_json_keep_nulls(body).alias("body"),
    )


def members(placed: Placed) -> DataFrame:
    return placed.positions.select("entity", "id", KEY, "pos", "chunk", "payload_id")

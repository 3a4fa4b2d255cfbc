"""Claiming: which eligible records a run takes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sluiceway.functions.expressions import run_time
from sluiceway.functions.predicates import eligible
from sluiceway.operators.joins import lookup
from sluiceway.operators.positions import with_positions
from sluiceway.schemas import COMPLETE, FLAG, STATUS, UPDATED
from sluiceway.session import write_once

# Decides how rows are claimed, not how many: up to this limit a top-n keeps its rows per
# task and merges them in one; above it the last row within the limit is looked for.
TOP_N = 2_000
# Ages are counted by spans of 2 ** 30 microseconds, some 18 minutes.
_SPAN_BITS = 30


def fifo_order(*ties: str) -> list[Column]:
    """Oldest update first, unknown last, then id and any further tie-breaks."""
    return [F.col(c).asc_nulls_last() for c in (UPDATED, "id", *ties)]


def _edge(df: DataFrame, bucket: Column, order: list[str], limit: int) -> tuple[Row, int] | None:
    """The row at place ``limit`` by (``bucket``, ``order``), ascending with nulls last, and
    how many rows come strictly before it.

    None when there are no more rows than that. Buckets are counted, which combines per
    task; only the rows of the bucket in which the limit falls are ranked, and of
    them only the columns that order them.
    """
    keyed = df.select(bucket.alias("bucket"), *order)
    upto = Window.orderBy(F.col("bucket").asc_nulls_last())
    sizes = keyed.groupBy("bucket").count().withColumn("upto", F.sum("count").over(upto))
    edge = sizes.filter(F.col("upto") >= limit).orderBy("upto").first()
    if edge is None:
        return None
    inside = keyed.filter(F.col("bucket").eqNullSafe(F.lit(edge["bucket"])))
    by = [F.col(c).asc_nulls_last() for c in order]
    written = write_once(inside, "boundary")
    earlier = edge["upto"] - edge["count"]
    last = with_positions(written, [], by, name="place").filter(F.col("place") == limit - earlier).first()
    ahead = earlier + written.filter(_before(last, order, dict(df.dtypes))).count()
    return last, ahead


def last_within(df: DataFrame, bucket: Column, order: list[str], limit: int) -> Row | None:
    """The row at place ``limit`` by (``bucket``, ``order``); None when there are no more rows."""
    found = _edge(df, bucket, order, limit)
    return None if found is None else found[0]


def _before(last: Row, order: list[str], types: Mapping[str, str]) -> Column:
    """Rows strictly before ``last``, ascending with nulls last; a null comparison means after."""
    before = F.lit(False)
    for name in reversed(order):
        at, column = last[name], F.col(name)
        if at is None:
            before = column.isNotNull() | (column.isNull() & before)
        else:
            value = F.lit(at).cast(types[name])
            before = (column < value) | ((column == value) & before)
    return F.coalesce(before, F.lit(False))


def _equal(last: Row, order: list[str], types: Mapping[str, str]) -> Column:
    same = [
        F.col(name).isNull() if last[name] is None else F.col(name) == F.lit(last[name]).cast(types[name])
        for name in order
    ]
    return F.coalesce(reduce(and_, same), F.lit(False))


def _leading(last: Row, order: list[str], types: Mapping[str, str]) -> Column:
    """The leading column compared plainly, for scans to filter by."""
    if last[order[0]] is None:
        return F.lit(True)
    return F.col(order[0]) <= F.lit(last[order[0]]).cast(types[order[0]])


def _up_to(df: DataFrame, bucket: Column, order: list[str], limit: int) -> DataFrame:
    """Exactly ``limit`` rows: those strictly before the row at that place by filter, and of
    the rows equal to it in all of ``order`` only as many as are missing.

    Equal rows are numbered apart by a hash of all their columns, then the columns, in
    sorted ranges, so a tie held by a third of all rows spans many tasks.
    """
    found = _edge(df, bucket, order, limit)
    if found is None:
        return df
    last, ahead = found
    types = dict(df.dtypes)
    lead = _leading(last, order, types)
    before = df.filter(lead & _before(last, order, types))
    tied = write_once(df.filter(lead & _equal(last, order, types)), "ties")
    plain = [F.col(c) for c, t in tied.dtypes if not t.startswith("map")]
    apart = [F.xxhash64(*plain)] + plain
    numbered = with_positions(tied, [], apart, name="__tie")
    return before.unionByName(numbered.filter(F.col("__tie") <= limit - ahead).drop("__tie"))


def take_first(df: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """The first ``limit`` rows by ``order``, ascending with nulls last; all without a limit.

    Exactly ``limit`` rows (or all there are). Rows equal in all of ``order`` are told apart
    by their other columns; which of fully equal rows are taken does not show.
    """
    if limit is None:
        return df
    if limit <= TOP_N:
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(limit)
    return _up_to(df, F.col(order[0]), order, limit)


def take_oldest(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of an outbox table by age and id.

    For a large limit the last row within it becomes values that the scan of the
    table filters by, so the records themselves are neither sorted nor shuffled.
    """
    order = [UPDATED, "id"]
    if limit is None or limit <= TOP_N:
        return take_first(df, order, limit)
    micros = F.unix_micros(F.col(UPDATED).cast("timestamp"))
    return _up_to(df, F.shiftright(micros, _SPAN_BITS), order, limit)


def claim_fifo(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Oldest eligible records, picked on the outbox table before any join."""
    return take_oldest(eligible(df), limit)


def claim_grouped(
    joined: DataFrame, limit: int | None = None, key: str = "project_unique_id", ties: tuple = ()
) -> DataFrame:
    """First rows by group, then age, of eligible records already joined.

    The limit counts joined rows, so a record that fans out counts repeatedly.
    """
    return take_first(joined, [key, UPDATED, "id", *ties], limit)


def claim_joined(
    enrich: Callable[[DataFrame], DataFrame],
    candidates: DataFrame,
    limit: int | None,
    key: str = "project_unique_id",
    ties: tuple = (),
    run: str = "",
) -> DataFrame:
    """``claim_grouped(enrich(candidates), limit, key, ties)``, with dimensions joined to the winners only.

    The limit is taken on the joined rows' ordering columns alone, so Spark prunes every
    dimension to its join keys. The winners (at most ``limit`` rows, written) are enriched
    alone, and of their joined rows exactly the claimed ones are kept, each as often as it
    was claimed; copies equal in the ordering columns are told apart by all their columns.
    ``enrich`` has to join record by record: a record's rows must not depend on others.
    """
    if limit is None:
        return claim_grouped(enrich(candidates), None, key, ties)
    order = [key, UPDATED, "id", *ties]
    won = write_once(claim_grouped(enrich(candidates).select(*order), limit, key, ties), "won", run)
    ids = won.select(F.col("id").alias("__won")).distinct()
    winners = candidates.join(ids, candidates["id"].eqNullSafe(ids["__won"]), "left_semi")
    joined = enrich(winners)
    wanted = won.groupBy(*order).agg(F.count("*").alias("__k"))
    plain = [F.col(c) for c, t in joined.dtypes if not t.startswith("map")]
    copies = Window.partitionBy(*order).orderBy(F.xxhash64(*plain), *plain)
    ranked = joined.withColumn("__r", F.row_number().over(copies))
    kept = lookup(ranked, wanted, {c: c for c in order}, null_safe=True)
    return kept.filter(F.col("__r") <= F.col("__k")).drop("__r", "__k")


def state_changes(
    records: DataFrame,
    entity: str,
    status: Column | str,
    run_id: str,
    run_ts: datetime | str,
    step: int,
    seen: Column | None = None,
    run_seq: int | None = None,
) -> DataFrame:
    """One change row per record, moving it to ``status`` at ``run_ts``.

    The flag is cleared on completion only. ``seen`` is the record's time of update that
    the change was made from, by default the run's own, which its claim has set.
    ``run_seq`` orders runs, by default by their time; ``step`` orders the changes of one.
    """
    status = F.lit(status) if isinstance(status, str) else status
    at = run_time(run_ts)
    seq = F.unix_micros(at) if run_seq is None else F.lit(run_seq)
    return records.select(
        F.lit(entity).alias("entity"),
        "id",
        (status != COMPLETE).alias(FLAG),
        status.alias(STATUS),
        at.alias(UPDATED),
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        (at if seen is None else seen.cast("timestamp")).alias("seen_at"),
        seq.cast("bigint").alias("run_seq"),
        at.cast("date").alias("day"),
    )

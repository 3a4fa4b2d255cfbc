"""Runs: claim, enrich, package, deliver, settle and report.

Delivery itself is outside: ``deliver`` takes the documents (and typically
writes them to a sink something else sends from) and returns the receipts.
Every result is a DataFrame; the caller writes them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.predicates import eligible, eligible_one
from sluiceway.operators.claim import claim_grouped, claim_joined, state_changes, take_oldest
from sluiceway.operators.joins import exclude_in_flight, stranded
from sluiceway.operators.packaging import documents, members, place
from sluiceway.operators.reporting import run_report, run_totals, union_all
from sluiceway.operators.settlement import settle
from sluiceway.plans.enrichment import Tables
from sluiceway.plans.entities import ENTITIES, MAX_ITEMS, EntitySpec
from sluiceway.schemas import PROCESSING, UPDATED
from sluiceway.session import release, write_once
from sluiceway.sources.tables import current_state, read_receipts

Deliver = Callable[[DataFrame], DataFrame]

# Stands for the entity's own limit; None means the whole backlog.
ENTITY_LIMIT = -1


@dataclass(frozen=True)
class Dispatch:
    """A claim and what it sends, before any receipt."""

    spec: EntitySpec
    run_id: str
    run_ts: datetime | str
    claimed: DataFrame  # id and time of update, one row per claimed record, written
    documents: DataFrame
    members: DataFrame
    run_seq: int | None = None

    def claim_changes(self) -> DataFrame:
        return state_changes(
            self.claimed,
            self.spec.entity,
            PROCESSING,
            self.run_id,
            self.run_ts,
            step=0,
            seen=F.col(UPDATED),
            run_seq=self.run_seq,
        )

    def open_claims(self) -> DataFrame:
        """Claims to publish, for other runs to leave these records alone."""
        return self.claimed.select(
            F.lit(self.spec.entity).alias("entity"),
            "id",
            F.lit(self.run_id).alias("run_id"),
            F.lit(True).alias("open"),
        )

    def stranded(self) -> DataFrame:
        """Claimed records that enrichment lost; they stay processing."""
        return stranded(self.claimed, self.members)

    def settle(self, receipts: DataFrame) -> DataFrame:
        return settle(
            self.members,
            receipts,
            entity=self.spec.entity,
            on_fail=self.spec.on_fail,
            run_id=self.run_id,
            run_ts=self.run_ts,
            run_seq=self.run_seq,
        )

    def release(self) -> bool:
        """Delete the run's own tables, once documents and changes are stored."""
        return release(self.claimed.sparkSession, self.run_id)

    def report(self, receipts: DataFrame) -> DataFrame:
        return run_report(self.members, receipts, self.spec.entity)


class RecordNotFound(KeyError):
    """There is nothing to send for the record.

    It does not exist or is not eligible; or it was claimed but lacks a parent,
    in which case ``dispatch`` holds the claim, to be recorded all the same.
    """

    def __init__(self, record_id: str, sent: Dispatch):
        super().__init__(record_id)
        self.dispatch = sent


@dataclass(frozen=True)
class SyncRun:
    dispatch: Dispatch
    changes: DataFrame
    report: DataFrame

    def new_state(self, state: DataFrame) -> DataFrame:
        """What the state this run was made from becomes."""
        return current_state(state, self.changes, self.dispatch.spec.entity, own=True)


def spec_of(entity: EntitySpec | str) -> EntitySpec:
    if isinstance(entity, EntitySpec):
        return entity
    if entity not in ENTITIES:
        raise ValueError(f"unsupported entity: {entity}")
    return ENTITIES[entity]


def dispatch(
    tables: Tables,
    entity: EntitySpec | str,
    *,
    run_id: str,
    run_ts: datetime | str,
    limit: int | None = ENTITY_LIMIT,
    max_items: int = MAX_ITEMS,
    claims: DataFrame | None = None,
    record_id: str | None = None,
    state: DataFrame | None = None,
    run_seq: int | None = None,
) -> Dispatch:
    """Claim records of one entity and build their documents.

    The claim is written once, whatever its size, and everything else is made from
    that table: documents, changes, open claims, what was stranded. So the outbox,
    and the claims that other runs publish, may change meanwhile.
    """
    spec = spec_of(entity)
    state = tables[spec.entity] if state is None else state
    limit = spec.limit if limit == ENTITY_LIMIT else limit
    one = record_id is not None
    candidates = eligible_one(state, record_id) if one else eligible(state)
    if claims is not None:
        candidates = exclude_in_flight(candidates, claims, spec.entity, run_id)

    if spec.claim_after_joins and one:
        # A single record is sent once, even where joins repeat it.
        claimed = claim_grouped(spec.enrich(tables, candidates), 1, ties=spec.ties)
    elif spec.claim_after_joins:
        # The limit is taken on join keys; only the winners are enriched.
        claimed = claim_joined(partial(spec.enrich, tables), candidates, limit, ties=spec.ties, run=run_id)
    else:
        claimed = candidates if one else take_oldest(candidates, limit)
    claimed = write_once(claimed, f"claim-{spec.entity}", run_id)
    enriched = claimed if spec.claim_after_joins else spec.enrich(tables, claimed)
    if spec.finish is not None:
        enriched = spec.finish(tables, enriched)

    placed = place(
        enriched,
        entity=spec.entity,
        fields=spec.fields(),
        order=spec.order(),
        run_id=run_id,
        max_items=max_items,
        packable=spec.packable() if spec.packable else None,
    )
    rows = members(placed)
    # Joins repeat a record's rows before the claim; its time of update is the same.
    ids = claimed.select("id", UPDATED)
    ids = ids.distinct() if spec.claim_after_joins else ids
    docs = documents(
        placed,
        entity=spec.entity,
        job_type=spec.job_type,
        items_field=spec.items_field,
        run_id=run_id,
    )
    return Dispatch(spec, run_id, run_ts, ids, docs, rows, run_seq)


def finish_run(sent: Dispatch, receipts: DataFrame) -> SyncRun:
    """Settle and report a dispatch from its receipts."""
    receipts = read_receipts(receipts)
    changes = sent.claim_changes().unionByName(sent.settle(receipts))
    return SyncRun(sent, changes, sent.report(receipts))


def sync_batch(
    tables: Tables, entity: EntitySpec | str, deliver: Deliver, **options
) -> SyncRun:
    """One batch of one entity; ``options`` as for :func:`dispatch`."""
    sent = dispatch(tables, entity, **options)
    return finish_run(sent, deliver(sent.documents))


def sync_one(
    tables: Tables, entity: EntitySpec | str, record_id: str, deliver: Deliver, **options
) -> SyncRun:
    """One eligible record; raises :class:`RecordNotFound` when nothing can be sent."""
    sent = dispatch(tables, entity, record_id=record_id, **options)
    if sent.members.isEmpty():
        raise RecordNotFound(record_id, sent)
    return finish_run(sent, deliver(sent.documents))


@dataclass(frozen=True)
class FullRun:
    runs: dict[str, SyncRun]
    report: DataFrame
    totals: DataFrame


def sync_all(
    tables: Tables,
    deliver: Deliver,
    entities: dict[str, EntitySpec] | None = None,
    **options,
) -> FullRun:
    """One batch of every entity, delivered in order, with totals.

    The entities are claimed and packaged by concurrent jobs, so that the last tasks of one
    leave no executor idle: none reads what another writes.
    """
    specs = ENTITIES if entities is None else entities
    spark = next(iter(tables.values())).sparkSession
    # Job groups, pools and tags of the caller's thread hold for the others.
    one = inheritable_thread_target(spark)(lambda spec: dispatch(tables, spec, **options))
    with ThreadPoolExecutor(max(1, len(specs))) as pool:
        sent = dict(zip(specs, pool.map(one, specs.values())))
    runs = {name: finish_run(run, deliver(run.documents)) for name, run in sent.items()}
    report = union_all(run.report for run in runs.values())
    return FullRun(runs, report, run_totals(report))


"""One query per operator, over whole star-schema tables.

Each takes ``(spark, folder)`` and has the same name as its SQL in
``oracle.py``, where it has one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import expressions as E
from sluiceway.functions.predicates import eligible, not_deleted
from sluiceway.operators import joins as J
from sluiceway.operators import ranking as R
from sluiceway.operators import rollups as A
from sluiceway.operators.claim import claim_fifo, claim_joined, fifo_order
from sluiceway.operators.packaging import place
from sluiceway.operators.positions import with_positions
from sluiceway.operators.reporting import count_all, count_pending, group_sizes
from sluiceway.plans import enrichment as P
from sluiceway.plans.entities import ENTITIES, MAX_ITEMS, EntitySpec, wetmill_spec
from sluiceway.plans.runs import (
    Dispatch,
    SyncRun,
    dispatch,
    finish_run,
    sync_all,
    sync_batch,
    sync_one,
)
from sluiceway.schemas import FLAG, STATUS, UPDATED
from sluiceway.session import scratch_path
from sluiceway.sources.sinks import append_changes, write_payloads, write_state
from sluiceway.sources.tables import current_state, read_changes, read_state
from sluiceway.starschema.relations import STAR_TABLES, WETMILL_KEY, StarSchema, star_schema
from sluiceway.streaming.drain import drain_stream

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run-1"
RUN_TS = "2030-01-01 00:00:00"
# When records are edited between two runs.
EDITED = "2029-06-01 00:00:00"
# Small enough for groups to be cut into several documents.
HOUSEHOLDS_PER_DOCUMENT = 100

SPECS = ENTITIES | {"wetmills": wetmill_spec(WETMILL_KEY)}
OUTBOXES = tuple(SPECS)

_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[StarSchema], DataFrame]) -> Callable[[StarSchema], DataFrame]:
    """Register ``fn`` under its own name, without a leading underscore."""
    _QUERIES[fn.__name__.lstrip("_")] = lambda spark, root: fn(star_schema(spark, root))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _when(column: str = UPDATED):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _state(df: DataFrame) -> DataFrame:
    return df.select("id", FLAG, STATUS, _when())


# Filters


@query
def filter_eligible(t):
    return _state(eligible(t["households"]))


@query
def filter_not_deleted(t):
    return not_deleted(t["farmers"]).select("id", "household_id")


@query
def semi_join_ids(t):
    wanted = eligible(t["wetmills"])
    return J.where_ids(t["wetmill_visits"], wanted, "wetmill_id").select("id", "wetmill_id")


@query
def anti_join_in_flight(t):
    return J.exclude_in_flight(eligible(t["households"]), t.claims(), "households").select("id")


# Joins


@query
def join_inner_lookup(t):
    dim = J.pick(t["projects"], pid="id", project_unique_id="project_unique_id")
    return J.lookup(t["farmer_groups"], dim, {"project_id": "pid"}).select(
        "id", "project_id", "project_unique_id"
    )


@query
def join_left_lookup(t):
    dim = J.pick(t["locations"], lid="id", location_name="location_name")
    return J.lookup(t["farmer_groups"], dim, {"location_id": "lid"}, "left").select(
        "id", "location_id", "location_name"
    )


@query
def join_left_composite(t):
    staffed = J.with_staff_role(
        t["farmer_groups"],
        t["project_staff_roles"],
        staff_role_id="id",
        worker_group="commcare_location_id",
    )
    return staffed.select("id", "staff_role_id", "worker_group")


@query
def join_self_roles(t):
    led = star_schema(t.spark, t.root, leaders=True)
    groups = led["farmer_groups"].select("id", "focal_farmer_id", "assistant_focal_farmer_id")
    focal = J.with_farmer_role(groups, led["farmers"], "focal_farmer_id", "focal")
    both = J.with_farmer_role(focal, led["farmers"], "assistant_focal_farmer_id", "assistant")
    return both.select("id", "focal_id", "focal_case_id", "assistant_id", "assistant_case_id")


@query
def join_residual_like(t):
    return J.programme_projects(
        t["wetmills"], t["project_staff_roles"], t["projects"], WETMILL_KEY
    ).select("id", "programme", "staff_role_id", "project_name", "project_unique_id")


@query
def stranded_claims(t):
    claimed = eligible(t["wetmills"])
    kept = P.enrich_wetmills(t, claimed, group_key=WETMILL_KEY)
    return J.stranded(claimed, kept).select("id")


# Aggregates


@query
def _count_pending(t):
    return count_pending(t["households"])


@query
def count_pending_all(t):
    return count_all({name: t[name] for name in OUTBOXES})


@query
def correlated_count(t):
    return A.child_count(
        t["farmer_groups"].select("id"), t["households"], "farmer_group_id", "household_count"
    )


@query
def lateral_count(t):
    return A.child_count(
        t["households"].select("id"),
        not_deleted(t["farmers"]),
        "household_id",
        "member_count",
        dtype="int",
    )


@query
def latest_by_type_wide(t):
    latest = A.latest_by_type(
        t["wetmill_visits"], t["wv_survey_responses"], P.RESPONSE_DATED, P.VISIT_DATED
    )
    wide = J.lookup(t["wetmills"].select("id"), latest, {"id": "wetmill_id"}, "left")
    return wide.select(
        "id",
        *[E.iso_date(f"{s}_date").alias(f"{s}_date") for s in P.RESPONSE_DATED + P.VISIT_DATED],
        *[F.col(f"{s}_date").isNotNull().alias(f"{s}_completed") for s in P.RESPONSE_DATED],
    )


# Rankings


@query
def top1_module_per_project(t):
    return R.current_module(t["training_modules"])


@query
def top2_names(t):
    named = R.participants(t["farmers"])
    return J.lookup(t["households"].select("id"), named, {"id": "household_id"}, "left")


@query
def current_previous_modules(t):
    projects = t["projects"].select("id")
    return J.lookup(projects, R.module_info(t["training_modules"]), {"id": "project_id"}, "left")


@query
def group_first_row(t):
    roles = P.join_staff_roles(t, eligible(t["project_staff_roles"]))
    return R.group_first_row(roles, "project_unique_id", "project_id")


# Claims


@query
def _claim_fifo(t):
    claimed = claim_fifo(t["households"], 200).select("id", UPDATED)
    return with_positions(claimed, [], fifo_order()).select("pos", "id", _when())


@query
def claim_fifo_large(t):
    claimed = claim_fifo(t["households"].select("id", FLAG, STATUS, UPDATED), 2_500)
    return _state(claimed)


@query
def claim_by_group(t):
    enrich = partial(P.enrich_sessions, t)
    claimed = claim_joined(enrich, eligible(t["training_sessions"]), 300, ties=("worker_group",))
    key = F.col("project_unique_id").asc_nulls_last()
    ordered = with_positions(claimed, [], [key, *fifo_order("worker_group")])
    return ordered.select("pos", "id", "project_unique_id", "worker_group")


@query
def claim_by_group_large(t):
    """A limit above the top-n's, over joined rows that repeat records: exactly 2,500 rows."""
    enrich = partial(P.enrich_sessions, t)
    claimed = claim_joined(enrich, eligible(t["training_sessions"]), 2_500, ties=("worker_group",))
    key = F.col("project_unique_id").asc_nulls_last()
    ordered = with_positions(claimed, [], [key, *fifo_order("worker_group")])
    return ordered.select("pos", "id", "project_unique_id", "worker_group")


@query
def claim_state(t):
    """All households after a claim of the entity's own limit."""
    sent = dispatch(t, "households", run_id=RUN_ID, run_ts=RUN_TS)
    return _state(current_state(t["households"], sent.claim_changes(), "households"))


@query
def claim_state_backlog(t):
    """All households after a claim of the whole backlog."""
    sent = dispatch(t, "households", run_id=RUN_ID, run_ts=RUN_TS, limit=None)
    return _state(current_state(t["households"], sent.claim_changes(), "households"))


# Scalar expressions


@query
def expr_prefer_id(t):
    return t["households"].select("id", E.prefer_id("sf_id", "id").alias("record_id"))


@query
def expr_full_name(t):
    name = E.full_name("first_name", "middle_name", "last_name")
    return t["users"].select("id", name.alias("staff_name"))


@query
def expr_replace(t):
    return t["project_staff_roles"].select("id", E.underscore("role").alias("role"))


@query
def expr_bool_text(t):
    flag = "is_primary_household_member"
    return t["farmers"].select(
        "id",
        E.yes_no(flag).alias("yes_no"),
        E.true_false(flag).alias("true_false"),
        E.py_bool(flag).alias("py_bool"),
    )


@query
def expr_date_text(t):
    return t["training_sessions"].select(
        "id", *[E.iso_date(c).alias(c) for c in ("date_session_1", "date_session_2")]
    )


@query
def expr_casts(t):
    picked = t["households"].select("id", "farm_size", "household_number", UPDATED)
    as_text = E.cast_all(picked, {"farm_size": "string", "household_number": "bigint"})
    dated = E.cast_all(as_text, {UPDATED: "date"})
    return dated.withColumn(UPDATED, E.iso_date(UPDATED))


@query
def expr_empty_to_null(t):
    case = E.empty_to_null("commcare_case_id")
    return t["farmers"].select("id", case.alias("case_id"))


# Enrichment of whole outbox tables


@query
def enrich_staff_roles(t):
    return P.enrich_staff_roles(t, t["project_staff_roles"]).drop(UPDATED)


@query
def enrich_groups(t):
    led = star_schema(t.spark, t.root, leaders=True)
    return P.enrich_groups(led, led["farmer_groups"]).drop(UPDATED)


@query
def enrich_sessions(t):
    return P.enrich_sessions(t, t["training_sessions"]).drop(UPDATED)


@query
def enrich_households(t):
    return P.enrich_households(t, t["households"]).drop(UPDATED)


@query
def enrich_farmers(t):
    return P.enrich_farmers(t, t["farmers"]).drop(UPDATED)


@query
def enrich_wetmills(t):
    rows = P.enrich_wetmills(t, t["wetmills"], group_key=WETMILL_KEY).drop(UPDATED)
    dates = [c for c in rows.columns if c.endswith("_date")]
    return rows.withColumns({c: E.iso_date(c) for c in dates})


# Packaging


def _max_items(spec: EntitySpec) -> int:
    return HOUSEHOLDS_PER_DOCUMENT if spec.entity == "households" else MAX_ITEMS


def _tables(t: StarSchema, entity: str) -> StarSchema:
    return star_schema(t.spark, t.root, leaders=entity == "farmer_groups")


def _backlog(t: StarSchema, entity: str, **options) -> Dispatch:
    """Everything eligible, in one run."""
    spec = SPECS[entity]
    return dispatch(
        _tables(t, entity),
        spec,
        run_id=RUN_ID,
        run_ts=RUN_TS,
        limit=None,
        max_items=_max_items(spec),
        **options,
    )


def _sync(t: StarSchema, entity: str) -> SyncRun:
    spec = SPECS[entity]
    return sync_batch(
        _tables(t, entity),
        spec,
        t.receipts,
        run_id=RUN_ID,
        run_ts=RUN_TS,
        limit=None,
        max_items=_max_items(spec),
    )


@query
def payload_docs(t):
    return _backlog(t, "households").documents


@query
def payload_docs_staff_roles(t):
    return _backlog(t, "project_staff_roles").documents


@query
def payload_docs_groups(t):
    return _backlog(t, "farmer_groups").documents


@query
def payload_docs_sessions(t):
    return _backlog(t, "training_sessions").documents


@query
def payload_docs_farmers(t):
    return _backlog(t, "farmers").documents


@query
def payload_docs_wetmills(t):
    return _backlog(t, "wetmills").documents


@query
def payload_docs_in_flight(t):
    """Packaging that leaves alone what another run holds."""
    return _backlog(t, "households", claims=t.claims()).documents


@query
def payload_positions(t):
    return _backlog(t, "households").members.drop("entity")


@query
def payload_excludes_empty(t):
    """Rows and packed items per group: empty households have a row but no item."""
    spec = SPECS["households"]
    placed = place(
        P.enrich_households(t, eligible(t["households"])),
        entity=spec.entity,
        fields=spec.fields(),
        order=spec.order(),
        run_id=RUN_ID,
        max_items=MAX_ITEMS,
        packable=spec.packable(),
    )
    return placed.rows().groupBy("unique_project_key").agg(
        F.count("*").alias("n_rows"), F.count("item").alias("n_items")
    )


@query
def _group_sizes(t):
    rows = P.enrich_households(t, eligible(t["households"]))
    return group_sizes(rows, "project_unique_id").withColumnRenamed(
        "project_unique_id", "unique_project_key"
    )


@query
def payload_sink(t):
    """The documents as a reader of the written sink sees them."""
    path = scratch_path(t.spark, "sink")
    write_payloads(_backlog(t, "households").documents, path)
    return t.spark.read.schema("value string, entity string").text(path).select(
        "entity", F.col("value").alias("body")
    )


# Settlement and whole runs


@query
def settle_receipts(t):
    sent = _backlog(t, "households")
    return _state(sent.settle(t.receipts(sent.documents)))


@query
def run_report(t):
    return _sync(t, "households").report


@query
def run_totals(t):
    led = star_schema(t.spark, t.root, leaders=True)
    return sync_all(
        led, t.receipts, SPECS, run_id=RUN_ID, run_ts=RUN_TS, limit=None
    ).totals


@query
def run_report_all(t):
    """The report of a run over all entities, one row for each."""
    led = star_schema(t.spark, t.root, leaders=True)
    return sync_all(led, t.receipts, SPECS, run_id=RUN_ID, run_ts=RUN_TS, limit=None).report


def _synced_state(entity: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        t = star_schema(spark, root)
        return _state(_sync(t, entity).new_state(t[entity]))

    return run


# At the entities' own limits, as a run takes them by default.


def _limited(t: StarSchema, entity: str) -> Dispatch:
    spec = SPECS[entity]
    return dispatch(
        _tables(t, entity), spec, run_id=RUN_ID, run_ts=RUN_TS, max_items=_max_items(spec)
    )


def _limited_documents(entity: str) -> Query:
    return lambda spark, root: _limited(star_schema(spark, root), entity).documents


def _limited_state(entity: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        t = star_schema(spark, root)
        sent = _limited(t, entity)
        return _state(finish_run(sent, t.receipts(sent.documents)).new_state(t[entity]))

    return run


def _one_document(entity: str) -> Query:
    """The document of the eligible record with the least id that has a row."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        t = star_schema(spark, root)
        tables, spec = _tables(t, entity), SPECS[entity]
        record_id = spec.enrich(tables, eligible(tables[entity])).agg(F.min("id")).first()[0]
        run = sync_one(tables, spec, record_id, t.receipts, run_id=RUN_ID, run_ts=RUN_TS)
        return run.dispatch.documents

    return run


_SHORT = {"project_staff_roles": "staff_roles", "farmer_groups": "groups", "training_sessions": "sessions"}
for _entity in OUTBOXES:
    _name = _SHORT.get(_entity, _entity)
    _QUERIES[f"payload_docs_limited_{_name}"] = _limited_documents(_entity)
    _QUERIES[f"sync_limited_{_name}"] = _limited_state(_entity)
    if _entity != "households":
        _QUERIES[f"sync_one_{_name}"] = _one_document(_entity)


_QUERIES |= {
    "sync_batch_staff_roles": _synced_state("project_staff_roles"),
    "sync_batch_groups": _synced_state("farmer_groups"),
    "sync_batch_sessions": _synced_state("training_sessions"),
    "sync_batch_households": _synced_state("households"),
    "sync_batch_farmers": _synced_state("farmers"),
    "sync_batch_wetmills": _synced_state("wetmills"),
}


@query
def sync_one_record(t):
    """The document of one household: the least eligible id that has a project."""
    grouped = t["farmer_groups"].filter(F.col("project_id").isNotNull())
    housed = J.where_ids(eligible(t["households"]), grouped, "farmer_group_id")
    record_id = housed.agg(F.min("id")).first()[0]
    run = sync_one(t, "households", record_id, t.receipts, run_id=RUN_ID, run_ts=RUN_TS)
    return run.dispatch.documents


@query
def log_two_runs(t):
    """Staff roles through the log: claim, settle, an edit of every tenth, claim and settle again.

    Both runs have the same time, refused roles are taken again, edited ones keep their own
    values until the second run takes them.
    """
    name, path = "project_staff_roles", scratch_path(t.spark, "log")
    tenth = F.col("id").cast("bigint") % 10 == 0
    edited = t[name].withColumns(
        {
            FLAG: F.when(tenth, F.lit(True)).otherwise(F.col(FLAG)),
            STATUS: F.when(tenth, F.lit("Pending")).otherwise(F.col(STATUS)),
            UPDATED: F.when(tenth, F.lit(EDITED).cast(t[name].schema[UPDATED].dataType)).otherwise(
                F.col(UPDATED)
            ),
        }
    )
    now = t[name]
    for seq in (1, 2):
        sent = dispatch(
            dict(t) | {name: now}, SPECS[name], run_id=f"run-{seq}", run_ts=RUN_TS, run_seq=seq, limit=None
        )
        append_changes(sent.claim_changes(), path)
        append_changes(sent.settle(t.receipts(sent.documents)), path)
        now = current_state(edited, read_changes(t.spark, path), name)
    return _state(now)


@query
def written_state(t):
    """Household state by way of the change log and a new version of the table."""
    path = scratch_path(t.spark, "state")
    sent = _backlog(t, "households")
    append_changes(sent.claim_changes(), f"{path}/changes")
    append_changes(sent.settle(t.receipts(sent.documents)), f"{path}/changes")
    log = read_changes(t.spark, f"{path}/changes")
    state = current_state(t["households"], log, "households")
    write_state(state.withColumn(UPDATED, F.col(UPDATED).cast("timestamp")), path, RUN_ID)
    return _state(read_state(t.spark, path, RUN_ID, "households"))


# Streaming


@query
def drain_available_now(t):
    """Documents of everything eligible, packaged by a drained stream."""
    spark = t.spark
    stream = (
        spark.readStream.schema(STAR_TABLES["orders"])
        .option("pathGlobFilter", "orders.parquet")
        .parquet(t.root)
    )
    streamed = StarSchema(spark, t.root)
    streamed.base["orders"] = stream
    path = scratch_path(spark, "drain")
    drained = drain_stream(
        streamed["households"],
        t,
        "households",
        path,
        f"{path}/checkpoint",
        run_ts=RUN_TS,
        max_items=HOUSEHOLDS_PER_DOCUMENT,
    )
    drained.awaitTermination()
    return spark.read.parquet(f"{path}/documents").drop("batch")

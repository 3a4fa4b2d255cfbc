"""Enrichment: one function per entity, from outbox rows to flat rows.

Large tables are reduced to what the rows reach before they are aggregated, so a
claim from a long history costs what the claim reaches, whatever its size.

Dimensions that hang off a farmer group are joined to each other first, at the
size of the group table, so the large side is joined once on its group key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.expressions import cast_all
from sluiceway.functions.predicates import not_deleted
from sluiceway.operators.folding import fold, foldable, unfold
from sluiceway.operators.joins import (
    lookup,
    narrow,
    pick,
    programme_projects,
    with_farmer_role,
    with_staff_role,
)
from sluiceway.operators.ranking import (
    current_module,
    group_first_row,
    module_info,
    participants,
)
from sluiceway.operators.rollups import child_count, latest_by_type
from sluiceway.schemas import UPDATED

Tables = Mapping[str, DataFrame]

# The survey types, by which date counts as their completion.
RESPONSE_DATED = (
    "cpqi",
    "kpis",
    "manager_needs_assessment",
    "infrastructure",
    "waste_water_management",
    "financials",
    "employees",
    "water_and_energy_use",
    "gender_equitable_business_practices",
)
VISIT_DATED = ("wet_mill_training", "routine_visit")

# Fixed value: the project key that wetmills are sent under.
WETMILL_GROUP_KEY = "coffee_global_sustainability"


def _group_context(
    t: Tables, rows: DataFrame, location: bool = False
) -> DataFrame:
    """Farmer groups with project, staff role and, if asked for, location.

    Repeats a group for every role its responsible staff holds in its project.
    """
    groups = pick(
        narrow(t["farmer_groups"], "id", rows, "farmer_group_id"),
        group_id="id",
        group_sf_id="sf_id",
        group_name="ffg_name",
        group_case_id="commcare_case_id",
        project_id="project_id",
        location_id="location_id",
        responsible_staff_id="responsible_staff_id",
    )
    projects = pick(t["projects"], pid="id", project_unique_id="project_unique_id")
    context = lookup(groups, projects, {"project_id": "pid"})
    if location:
        places = pick(t["locations"], lid="id", location_name="location_name")
        context = lookup(context, places, {"location_id": "lid"}, "left")
    return with_staff_role(
        context, t["project_staff_roles"], worker_group="commcare_location_id"
    )


def join_staff_roles(t: Tables, roles: DataFrame) -> DataFrame:
    """Roles with their project and staff member; unmatched roles drop out."""
    projects = pick(
        t["projects"],
        pid="id",
        project_name="project_name",
        project_unique_id="project_unique_id",
    )
    staff = pick(
        narrow(t["users"], "id", roles, "staff_id"),
        uid="id",
        staff_sf_id="sf_id",
        first_name="first_name",
        middle_name="middle_name",
        last_name="last_name",
        staff_status="status",
    )
    kept = roles.select(
        "id",
        "sf_id",
        "project_id",
        "staff_id",
        "tns_id",
        "role",
        "commcare_location_id",
        "commcare_case_id",
        UPDATED,
    )
    return lookup(lookup(kept, projects, {"project_id": "pid"}), staff, {"staff_id": "uid"})


def add_group_modules(t: Tables, joined: DataFrame) -> DataFrame:
    """Current and previous module, by the project of each group's first row."""
    modules = narrow(t["training_modules"], "project_id", joined, "project_id")
    leads = group_first_row(joined, "project_unique_id", "project_id").withColumnRenamed(
        "project_id", "lead_project"
    )
    per_group = lookup(leads, module_info(modules), {"lead_project": "project_id"}, "left").drop(
        "lead_project"
    )
    return lookup(
        joined, per_group, {"project_unique_id": "project_unique_id"}, "left", null_safe=True
    )


def enrich_staff_roles(t: Tables, roles: DataFrame) -> DataFrame:
    return add_group_modules(t, join_staff_roles(t, roles))


def enrich_groups(t: Tables, groups: DataFrame) -> DataFrame:
    projects = pick(
        t["projects"],
        pid="id",
        project_sf_id="sf_id",
        project_name="project_name",
        project_unique_id="project_unique_id",
    )
    places = pick(t["locations"], lid="id", location_sf_id="sf_id", location_name="location_name")
    kept = groups.select(
        "id",
        "sf_id",
        "tns_id",
        "commcare_case_id",
        "ffg_name",
        "status",
        "project_id",
        "location_id",
        "responsible_staff_id",
        "focal_farmer_id",
        "assistant_focal_farmer_id",
        UPDATED,
    ).withColumnsRenamed(
        {"focal_farmer_id": "focal_key", "assistant_focal_farmer_id": "assistant_key"}
    )
    households = narrow(t["households"], "farmer_group_id", groups, "id")
    leaders = groups.select(
        F.explode(F.array("focal_farmer_id", "assistant_focal_farmer_id")).alias("leader")
    )
    farmers = narrow(t["farmers"], "id", leaders, "leader")
    counted = child_count(kept, households, "farmer_group_id", "household_count")
    placed = lookup(counted, projects, {"project_id": "pid"})
    placed = lookup(placed, places, {"location_id": "lid"}, "left")
    staffed = with_staff_role(
        placed,
        t["project_staff_roles"],
        staff_role_id="id",
        staff_role_sf_id="sf_id",
        worker_group="commcare_location_id",
    )
    led = with_farmer_role(staffed, farmers, "focal_key", "focal")
    return with_farmer_role(led, farmers, "assistant_key", "assistant").drop(
        "focal_key", "assistant_key"
    )


def enrich_sessions(t: Tables, sessions: DataFrame) -> DataFrame:
    """Sessions with module, group and responsible staff; unmatched ones drop out."""
    modules = pick(
        narrow(t["training_modules"], "id", sessions, "module_id"),
        mid="id",
        module_name="module_name",
        module_number="module_number",
    )
    staff = pick(t["users"], staff_id="id", staff_sf_id="sf_id")
    context = lookup(
        _group_context(t, sessions, location=True),
        staff.withColumn("uid", F.col("staff_id")),
        {"responsible_staff_id": "uid"},
    )
    kept = cast_all(
        sessions.select(
            "id",
            "sf_id",
            "commcare_case_id",
            "module_id",
            "farmer_group_id",
            "date_session_1",
            "date_session_2",
            UPDATED,
        ),
        {"date_session_1": "string", "date_session_2": "string"},
    )
    with_module = lookup(kept, modules, {"module_id": "mid"})
    return lookup(with_module, context, {"farmer_group_id": "group_id"})


def enrich_households(t: Tables, households: DataFrame) -> DataFrame:
    """Households with member count, participants, group, staff and current module."""
    farmers = narrow(t["farmers"], "household_id", households, "id")
    kept = households.select(
        "id",
        "sf_id",
        "household_name",
        "tns_id",
        "status",
        "visited_for_fv_aa",
        "fv_aa_sampling_round",
        "farmer_group_id",
        UPDATED,
    )
    counted = child_count(kept, not_deleted(farmers), "household_id", "member_count", dtype="int")
    named = lookup(counted, participants(farmers), {"id": "household_id"}, "left")
    context = lookup(
        _group_context(t, households),
        current_module(t["training_modules"]).withColumnRenamed("project_id", "mpid"),
        {"project_id": "mpid"},
        "left",
    )
    return lookup(
        named,
        context.withColumn("gid", F.col("group_id")),
        {"farmer_group_id": "gid"},
    )


def enrich_farmers(t: Tables, farmers: DataFrame) -> DataFrame:
    """Farmers with household, group and staff; unmatched ones drop out.

    The wide rows of a backlog are exchanged by both keys, so their values travel folded.
    """
    # Joined by the same key next, which keeps what the claim reaches: no need to narrow first.
    homes = pick(
        t["households"],
        hid="id",
        household_sf_id="sf_id",
        household_name="household_name",
        household_number="household_number",
        household_tns_id="tns_id",
        household_farm_size=F.col("farm_size").cast("string"),
    )
    # A group's farmers are many, so their keys are combined before they are exchanged.
    context = _group_context(t, farmers.select("farmer_group_id").distinct(), location=True)
    kept = farmers.select(
        "id",
        "sf_id",
        "first_name",
        "middle_name",
        "last_name",
        "age",
        "gender",
        "phone_number",
        "other_id",
        "is_primary_household_member",
        "status",
        "tns_id",
        "commcare_case_id",
        "household_id",
        "farmer_group_id",
        UPDATED,
    )
    own = foldable(kept, keep=("household_id", "farmer_group_id"))
    housed = lookup(fold(kept, "folded", own), homes, {"household_id": "hid"})
    home = foldable(housed, keep=("farmer_group_id",))
    grouped = lookup(
        fold(housed, "folded", home),
        context.withColumn("gid", F.col("group_id")),
        {"farmer_group_id": "gid"},
    )
    return unfold(grouped, "folded", own + home).select(
        *kept.columns, *[c for c in homes.columns if c != "hid"], *context.columns
    )


def enrich_wetmills(
    t: Tables,
    wetmills: DataFrame,
    group_key: str = WETMILL_GROUP_KEY,
) -> DataFrame:
    """Wetmills with staff role, project and latest survey dates and flags.

    A survey counts as completed when its latest date is known.
    """
    live = not_deleted(wetmills)
    visits = narrow(t["wetmill_visits"], "wetmill_id", wetmills, "id")
    responses = narrow(t["wv_survey_responses"], "form_visit_id", visits, "id")
    latest = latest_by_type(visits, responses, RESPONSE_DATED, VISIT_DATED)
    kept = live.select(
        "id",
        "user_id",
        "wet_mill_unique_id",
        "commcare_case_id",
        "name",
        "mill_status",
        "exporting_status",
        "programme",
        "country",
        "manager_name",
        "manager_role",
        "comments",
        "registration_date",
        "status",
        "mill_external_id",
        UPDATED,
    )
    held = programme_projects(kept, t["project_staff_roles"], t["projects"], group_key)
    dated = lookup(held, latest, {"id": "wetmill_id"}, "left")
    return dated.withColumns(
        {f"{s}_completed": F.col(f"{s}_date").isNotNull() for s in RESPONSE_DATED}
    )

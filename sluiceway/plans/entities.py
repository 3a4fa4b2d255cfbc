"""The six entities as data: how to claim, enrich, package and settle each.

A new entity is one more ``EntitySpec`` and an enrichment function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.expressions import (
    const,
    empty_to_null,
    full_name,
    iso_date,
    prefer_id,
    py_bool,
    true_false,
    underscore,
    yes_no,
)
from sluiceway.plans import enrichment
from sluiceway.plans.enrichment import RESPONSE_DATED, Tables
from sluiceway.schemas import FAILED, PENDING, UPDATED

Enrich = Callable[[Tables, DataFrame], DataFrame]

# Documents are cut at this many items, so that a group of any size is spread
# over many tasks. It is above every default claim limit.
MAX_ITEMS = 10_000


@dataclass(frozen=True)
class EntitySpec:
    """How one entity is synchronised.

    ``claim_after_joins`` entities are joined first and claimed by group, so a
    record without its dimensions stays pending. The others are claimed oldest
    first and joined afterwards, so such a record is left processing.
    """

    entity: str
    job_type: str
    items_field: str
    limit: int
    enrich: Enrich
    fields: Callable[[], dict[str, Column]]
    claim_after_joins: bool = False
    finish: Enrich | None = None
    packable: Callable[[], Column] | None = None
    on_fail: str = FAILED
    ties: tuple[str, ...] = ()
    by_age: bool = True

    def order(self) -> list[str]:
        """Columns that order the items of a document."""
        return [UPDATED, "id", *self.ties] if self.by_age else ["id", *self.ties]


# The keys below are the payload contract and so are fixed values, in its order.


def _staff_role_fields() -> dict[str, Column]:
    name = full_name("first_name", "middle_name", "last_name")
    return {
        "projectRoleId": prefer_id("sf_id", "id"),
        "projectRoleName": name,
        "staffName": name,
        "staffStatus": F.col("staff_status"),
        "tnsId": F.col("tns_id"),
        "commCareCaseId": F.col("commcare_case_id"),
        "roleForCommCare": underscore("role"),
        "ccMobileWorkerGroupId": F.col("commcare_location_id"),
        "staffId": prefer_id("staff_sf_id", "staff_id"),
        "currentModule": F.col("current_number"),
        "currentModuleName": F.col("current_name"),
        "previousModule": F.col("previous_number"),
        "previousModuleName": F.col("previous_name"),
        "projectName": F.col("project_name"),
        "projectUniqueId": F.col("project_unique_id"),
    }


def _group_fields() -> dict[str, Column]:
    return {
        "trainingGroupId": prefer_id("sf_id", "id"),
        "trainingGroupName": F.col("ffg_name"),
        "project": prefer_id("project_sf_id", "project_id"),
        "projectName": F.col("project_name"),
        "projectUniqueId": F.col("project_unique_id"),
        "type": const(None),
        "description": const(None),
        "tnsId": F.col("tns_id"),
        "commCareCaseId": F.col("commcare_case_id"),
        "locationName": F.col("location_name"),
        "groupStatus": F.col("status"),
        "projectLocationId": prefer_id("location_sf_id", "location_id"),
        "ccMobileWorkerGroupId": F.col("worker_group"),
        "staffId": prefer_id("staff_role_sf_id", "staff_role_id"),
        "cooperativeName": const(None),
        "householdCounter": F.col("household_count"),
        "focalFarmerId": prefer_id("focal_case_id", "focal_id"),
        "assistantFocalFarmerId": prefer_id("assistant_case_id", "assistant_id"),
    }


def _session_fields() -> dict[str, Column]:
    return {
        "sessionId": prefer_id("sf_id", "id"),
        "trainingModuleName": F.col("module_name"),
        "trainingModuleNumber": F.col("module_number"),
        "commCareCaseId": F.col("commcare_case_id"),
        "trainingGroupCommCareId": F.col("group_case_id"),
        "trainingGroupLocationName": F.col("location_name"),
        "ccMobileWorkerGroupId": F.col("worker_group"),
        "sessionStatus": const("Active"),
        "sessionOneDate": F.col("date_session_1"),
        "sessionTwoDate": F.col("date_session_2"),
        "trainingGroupName": F.col("group_name"),
        "trainingGroupResponsibleStaff": prefer_id("staff_sf_id", "staff_id"),
    }


def _household_fields() -> dict[str, Column]:
    record = prefer_id("sf_id", "id")
    return {
        "householdId": record,
        "householdName": F.col("household_name"),
        "numberOfMembers": F.col("member_count"),
        "tnsId": F.col("tns_id"),
        "fvAAVisited": yes_no("visited_for_fv_aa"),
        "fvAASampled": const("Yes"),
        "fvAACurrentSamplingRound": F.col("fv_aa_sampling_round"),
        "householdStatus": F.col("status"),
        "commCareCaseId": record,
        "ccMobileWorkerGroupId": F.col("worker_group"),
        "trainingGroupId": prefer_id("group_sf_id", "group_id"),
        "trainingGroupName": F.col("group_name"),
        "projectUniqueId": F.col("project_unique_id"),
        "householdParticipants": F.col("household_participants"),
        "moduleName": F.col("module_name"),
        "moduleNumber": F.col("module_number"),
    }


def _farmer_fields() -> dict[str, Column]:
    return {
        "participantName": F.col("first_name"),
        "participantId": prefer_id("sf_id", "id"),
        "trainingGroupCommCareId": F.col("group_case_id"),
        "commCareCaseId": F.col("commcare_case_id"),
        "participantMiddleName": F.col("middle_name"),
        "participantLastName": F.col("last_name"),
        "participantAge": F.col("age"),
        "participantGender": F.col("gender"),
        "participantPhoneNumber": F.col("phone_number"),
        "participantOtherIDNumber": F.col("other_id"),
        "participantPrimaryHouseholdMember": py_bool("is_primary_household_member"),
        "householdId": F.col("household_tns_id"),
        "householdPIMAId": prefer_id("household_sf_id", "household_id"),
        "householdName": F.col("household_name"),
        "HHID": F.col("household_number"),
        "householdFarmSize": F.col("household_farm_size"),
        "tnsId": F.col("tns_id"),
        "market": const(None),
        "trainingGroupLocationName": F.col("location_name"),
        "ccMobileWorkerGroupId": F.col("worker_group"),
        "trainingGroupId": prefer_id("group_sf_id", "group_id"),
        "status": F.col("status"),
        "measurementGroupId": const(None),
        "measurementGroupCommCareId": const(None),
        "participantVisibility": const(None),
        "commCareCaseStatus": F.col("status"),
    }


# Payload name of each survey that reports a flag and a date.
SURVEY_FIELDS = {
    "manager_needs_assessment": "managerNeedsAssessment",
    "infrastructure": "infrastructure",
    "waste_water_management": "wasteWaterManagement",
    "kpis": "kpis",
    "financials": "financials",
    "employees": "employees",
    "cpqi": "cpqi",
    "water_and_energy_use": "waterAndEnergyUse",
    "gender_equitable_business_practices": "genderEquitableBusinessPractices",
}
assert set(SURVEY_FIELDS) == set(RESPONSE_DATED)


def _wetmill_fields() -> dict[str, Column]:
    registered = iso_date("registration_date")
    fields = {
        "commCareCaseId": F.col("commcare_case_id"),
        "tnsId": F.col("wet_mill_unique_id"),
        "comments": F.col("comments"),
        "country": F.col("country"),
        "dateBASignature": registered,
        "exportingStatus": F.col("exporting_status"),
        "managerName": F.col("manager_name"),
        "managerRole": F.col("manager_role"),
        "programme": F.col("programme"),
        "registrationDate": registered,
        "wetmillName": F.col("name"),
        "millStatus": F.col("mill_status"),
        "status": F.col("status"),
    }
    for survey, field in SURVEY_FIELDS.items():
        if survey == "gender_equitable_business_practices":  # after the visits, by the contract
            fields["wetMillTrainingDate"] = iso_date("wet_mill_training_date")
            fields["routineVisitDate"] = iso_date("routine_visit_date")
        fields[f"{field}Completed"] = true_false(f"{survey}_completed")
        fields[f"{field}Date"] = iso_date(f"{survey}_date")
    return fields | {
        "ccMobileWorkerGroupId": F.col("worker_group"),
        "staffId": prefer_id("staff_case_id", "staff_role_id"),
        "millExternalId": empty_to_null("mill_external_id"),
    }


def wetmill_spec(group_key: str = enrichment.WETMILL_GROUP_KEY) -> EntitySpec:
    """Wetmills, sent under ``group_key``."""
    return EntitySpec(
        entity="wetmills",
        job_type="Wetmill",
        items_field="wetmills",
        limit=500,
        enrich=partial(enrichment.enrich_wetmills, group_key=group_key),
        fields=_wetmill_fields,
        ties=("staff_role_id",),
        by_age=False,
    )


# In the order in which a whole run takes them.
ENTITIES: dict[str, EntitySpec] = {
    spec.entity: spec
    for spec in (
        EntitySpec(
            entity="project_staff_roles",
            job_type="Project Role",
            items_field="projectRoles",
            limit=500,
            enrich=enrichment.join_staff_roles,
            finish=enrichment.add_group_modules,
            fields=_staff_role_fields,
            claim_after_joins=True,
            on_fail=PENDING,
        ),
        EntitySpec(
            entity="farmer_groups",
            job_type="Training Group",
            items_field="trainingGroups",
            limit=500,
            enrich=enrichment.enrich_groups,
            fields=_group_fields,
            ties=("staff_role_id",),
        ),
        EntitySpec(
            entity="training_sessions",
            job_type="Training Session",
            items_field="trainingSessions",
            limit=300,
            enrich=enrichment.enrich_sessions,
            fields=_session_fields,
            claim_after_joins=True,
            ties=("worker_group",),
        ),
        EntitySpec(
            entity="households",
            job_type="Household Sampling",
            items_field="households",
            limit=200,
            enrich=enrichment.enrich_households,
            fields=_household_fields,
            packable=lambda: F.col("member_count") != 0,
            ties=("worker_group",),
        ),
        EntitySpec(
            entity="farmers",
            job_type="Participant",
            items_field="participants",
            limit=500,
            enrich=enrichment.enrich_farmers,
            fields=_farmer_fields,
            ties=("worker_group",),
        ),
        wetmill_spec(),
    )
}

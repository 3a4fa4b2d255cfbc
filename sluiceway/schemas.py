"""Schemas of the twelve relations and of the tables this library adds.

Relation and column names are the data model an existing outbox database
already has, so they are fixed values.
"""

from __future__ import annotations

# Outbox columns, present on every relation in OUTBOX_RELATIONS.
FLAG = "send_to_commcare"
STATUS = "send_to_commcare_status"
UPDATED = "updated_at"

# Record states.
PENDING = "Pending"
PROCESSING = "Processing"
COMPLETE = "Complete"
FAILED = "Failed"


_OUTBOX = f", {FLAG} boolean, {STATUS} string, {UPDATED} timestamp"

# Schemas are DDL text, which readers take as it is.
RELATIONS: dict[str, str] = {
    "projects": (
        "id string, sf_id string, project_name string, project_unique_id string"
    ),
    "users": (
        "id string, sf_id string, first_name string, middle_name string,"
        " last_name string, status string"
    ),
    "project_staff_roles": (
        "id string, sf_id string, project_id string, staff_id string, tns_id string,"
        " role string, commcare_location_id string, commcare_case_id string"
        + _OUTBOX
    ),
    "training_modules": (
        "id string, project_id string, module_name string, module_number int,"
        " current_previous string, current_module boolean, is_deleted boolean,"
        " updated_at timestamp"
    ),
    "farmer_groups": (
        "id string, sf_id string, tns_id string, commcare_case_id string,"
        " ffg_name string, status string, project_id string, location_id string,"
        " responsible_staff_id string, focal_farmer_id string,"
        " assistant_focal_farmer_id string"
        + _OUTBOX
    ),
    "locations": ("id string, sf_id string, location_name string"),
    "households": (
        "id string, sf_id string, household_name string, household_number int,"
        " tns_id string, commcare_case_id string, status string,"
        " visited_for_fv_aa boolean, sampled_for_fv_aa boolean,"
        " fv_aa_sampling_round int, farm_size decimal(10,2), farmer_group_id string"
        + _OUTBOX
    ),
    "farmers": (
        "id string, sf_id string, first_name string, middle_name string,"
        " last_name string, age int, gender string, phone_number string,"
        " other_id string, is_primary_household_member boolean, status string,"
        " tns_id string, commcare_case_id string, household_id string,"
        " farmer_group_id string, is_deleted boolean"
        + _OUTBOX
    ),
    "training_sessions": (
        "id string, sf_id string, commcare_case_id string, module_id string,"
        " farmer_group_id string, date_session_1 date, date_session_2 date"
        + _OUTBOX
    ),
    "wetmills": (
        "id string, user_id string, wet_mill_unique_id string,"
        " commcare_case_id string, name string, mill_status string,"
        " exporting_status string, programme string, country string,"
        " manager_name string, manager_role string, comments string, status string,"
        " mill_external_id string, registration_date date, is_deleted boolean"
        + _OUTBOX
    ),
    "wetmill_visits": (
        "id string, wetmill_id string, visit_date date, is_deleted boolean"
    ),
    "wv_survey_responses": (
        "form_visit_id string, survey_type string, completed_date date"
    ),
}

# One row per delivery attempt of a document.
RECEIPTS = ("payload_id string, status_code int")

# Records another run holds.
CLAIMS = ("entity string, id string, run_id string, open boolean")

# One row per record whose outbox state changes; appended, never updated. ``seen_at`` is
# the time of update the record had when the change was made.
CHANGES = (
    f"entity string, id string, {FLAG} boolean, {STATUS} string,"
    f" {UPDATED} timestamp, run_id string, step int, seen_at timestamp, run_seq long, day date"
)

# One row per document to deliver.
DOCUMENTS = (
    "entity string, run_id string, payload_id string, unique_project_key string,"
    " chunk long, n_items int, body string"
)

# One row per record placed in a document (more than one when joins fan out).
MEMBERS = (
    "entity string, id string, unique_project_key string, pos long, chunk long,"
    " payload_id string"
)

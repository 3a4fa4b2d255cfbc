"""The queries of ``queries.py`` as SQL, to check their results against.

Written the way the question reads (correlated subqueries, one aggregate per
survey type, plain windows), not the way the Spark plans work.
"""

from __future__ import annotations

import re

from sluiceway.starschema.queries import EDITED, HOUSEHOLDS_PER_DOCUMENT, RUN_ID, RUN_TS
from sluiceway.starschema.relations import (
    CUSTOMERS_PER_STAFF,
    ROLES,
    SEGMENTS,
    SURVEYS,
    WETMILL_KEY,
)


# Fixed values of the contract, written out here again so that a wrong one on either side shows.
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
MAX_ITEMS = 10_000
LIMITS = {
    "project_staff_roles": 500,
    "farmer_groups": 500,
    "training_sessions": 300,
    "households": 200,
    "farmers": 500,
    "wetmills": 500,
}


def _words(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _sf_id(prefix: str, key: str, subject: str, null: str, empty: str) -> str:
    return (
        f"CASE {subject} WHEN '{null}' THEN NULL WHEN '{empty}' THEN ''"
        f" ELSE '{prefix}' || {key} END"
    )


_STAFF = f"CAST(c_custkey // {CUSTOMERS_PER_STAFF} AS VARCHAR)"
_CUSTOMER_TIME = (
    "CASE WHEN c_nationkey <> 11 THEN"
    " CAST(DATE '2024-01-01' + c_nationkey * 7 % 30 AS TIMESTAMP) END"
)
_FARMER_ID = (
    "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'"
    " || date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"
)
_GROUP_COLUMNS = f"""
    CAST(c_custkey AS VARCHAR) AS id,
    {_sf_id("G", "c_custkey", "c_mktsegment", "MACHINERY", "BUILDING")} AS sf_id,
    c_name AS tns_id,
    'GC' || c_custkey AS commcare_case_id,
    'Group ' || c_custkey AS ffg_name,
    CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'Inactive' END AS status,
    CASE WHEN c_nationkey <> 6 THEN CAST(c_nationkey AS VARCHAR) END AS project_id,
    CAST(c_nationkey % 7 AS VARCHAR) AS location_id,
    CASE WHEN c_acctbal > -900 THEN {_STAFF} END AS responsible_staff_id,
    CASE WHEN c_nationkey <> 8 THEN c_nationkey <> 9 END AS send_to_commcare,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Complete' WHEN 'FURNITURE' THEN 'Processing'
         ELSE 'Pending' END AS send_to_commcare_status,
    {_CUSTOMER_TIME} AS updated_at
"""

# In order of dependency.
VIEWS = {
    "projects": f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS id,
            {_sf_id("PR", "n_nationkey", "r_name", "AFRICA", "AMERICA")} AS sf_id,
            n_name || '_' || ({_words(SEGMENTS)})[n_nationkey // 5 % 5 + 1] AS project_name,
            CASE WHEN r_name = 'ASIA' THEN r_name WHEN n_name <> 'NATION_24' THEN n_name END
                AS project_unique_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "users": """
        SELECT CAST(s_suppkey AS VARCHAR) AS id,
            CASE WHEN s_acctbal > 0 THEN 'U' || s_suppkey END AS sf_id,
            s_name AS first_name,
            CASE WHEN s_nationkey < 8 THEN '' WHEN s_nationkey < 16 THEN 'M' END AS middle_name,
            'N' || s_nationkey AS last_name,
            CASE WHEN s_acctbal > 1000 THEN 'Active' END AS status
        FROM supplier""",
    "project_staff_roles": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS id,
            {_sf_id("R", "c_custkey", "c_mktsegment", "BUILDING", "MACHINERY")} AS sf_id,
            CAST(c_nationkey AS VARCHAR) AS project_id,
            CASE WHEN c_mktsegment <> 'FURNITURE' THEN {_STAFF} END AS staff_id,
            c_name AS tns_id,
            ({_words(ROLES)})[c_nationkey % 2 + 1] AS role,
            CASE WHEN c_acctbal > 0 THEN 'W' || c_custkey END AS commcare_location_id,
            CASE WHEN c_nationkey <> 3 THEN 'RC' || c_custkey END AS commcare_case_id,
            c_acctbal > -500 AS send_to_commcare,
            CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Complete' WHEN 'BUILDING' THEN 'Failed'
                 ELSE 'Pending' END AS send_to_commcare_status,
            {_CUSTOMER_TIME} AS updated_at
        FROM customer""",
    "training_modules": """
        SELECT CAST(p_partkey AS VARCHAR) AS id,
            CAST(p_partkey % 25 AS VARCHAR) AS project_id,
            p_name || ' ' || p_partkey AS module_name,
            CASE WHEN p_size <> 20 THEN p_size END AS module_number,
            (['Current', 'Previous', 'Future'])[p_partkey % 3 + 1] AS current_previous,
            CASE WHEN p_size <> 15 THEN p_size > 10 END AS current_module,
            CASE WHEN p_size <> 22 THEN p_size % 7 = 0 END AS is_deleted,
            CASE WHEN p_size <> 50 THEN CAST(DATE '2020-01-01' + p_size AS TIMESTAMP) END
                AS updated_at
        FROM part""",
    "farmer_groups": f"SELECT {_GROUP_COLUMNS} FROM customer",
    "locations": """
        SELECT CAST(r_regionkey AS VARCHAR) AS id,
            CASE WHEN r_name <> 'ASIA' THEN 'L' || r_regionkey END AS sf_id,
            r_name AS location_name
        FROM region""",
    "households": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
            {_sf_id("H", "o_orderkey", "o_orderpriority", "1-URGENT", "2-HIGH")} AS sf_id,
            'Home ' || o_orderkey AS household_name,
            CAST(o_orderkey % 1000 AS INTEGER) AS household_number,
            'T' || o_orderkey AS tns_id,
            'HC' || o_orderkey AS commcare_case_id,
            CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'Active' END AS status,
            CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderkey % 2 = 0 END AS visited_for_fv_aa,
            CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 4 AS INTEGER) END
                AS fv_aa_sampling_round,
            CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 700 AS DECIMAL(10, 2)) END
                AS farm_size,
            CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS farmer_group_id,
            CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority <> '5-LOW' END
                AS send_to_commcare,
            CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Failed' ELSE 'Complete' END
                AS send_to_commcare_status,
            CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS updated_at
        FROM orders""",
    "farmers": f"""
        SELECT {_FARMER_ID} AS id,
            CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber <> 2 THEN 'F' || {_FARMER_ID} END
                AS sf_id,
            CASE WHEN l_linenumber <> 7 THEN 'F' || l_partkey END AS first_name,
            CASE WHEN l_linenumber < 4 THEN 'M' || l_suppkey END AS middle_name,
            'L' || l_suppkey AS last_name,
            CAST(l_quantity AS INTEGER) AS age,
            l_linestatus AS gender,
            CASE WHEN l_linenumber = 3 THEN '07' || l_partkey END AS phone_number,
            CAST(NULL AS VARCHAR) AS other_id,
            CASE WHEN l_linenumber <> 5 THEN l_linestatus = 'O' END AS is_primary_household_member,
            CASE WHEN l_returnflag = 'R' THEN 'Inactive' ELSE 'Active' END AS status,
            'TF' || {_FARMER_ID} AS tns_id,
            CASE WHEN l_linenumber = 6 THEN '' WHEN l_linenumber > 1 THEN 'FC' || {_FARMER_ID} END
                AS commcare_case_id,
            CAST(l_orderkey AS VARCHAR) AS household_id,
            CAST(l_partkey AS VARCHAR) AS farmer_group_id,
            CASE WHEN l_returnflag = 'R' THEN true
                 WHEN l_returnflag <> 'N' OR l_linenumber <> 6 THEN false END AS is_deleted,
            CASE WHEN l_linenumber <> 4 THEN l_linestatus = 'O' END AS send_to_commcare,
            CASE l_returnflag WHEN 'A' THEN 'Pending' WHEN 'N' THEN 'Complete' ELSE 'Failed' END
                AS send_to_commcare_status,
            CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS updated_at
        FROM lineitem""",
    "led_groups": f"""
        SELECT {_GROUP_COLUMNS},
            (SELECT min(id) FROM farmers WHERE farmer_group_id = CAST(c_custkey AS VARCHAR))
                AS focal_farmer_id,
            CASE WHEN c_nationkey <> 5 THEN
                (SELECT max(id) FROM farmers WHERE farmer_group_id = CAST(c_custkey AS VARCHAR))
            END AS assistant_focal_farmer_id
        FROM customer""",
    "training_sessions": """
        SELECT CAST(event_id AS VARCHAR) AS id,
            CASE event_type WHEN 'click' THEN NULL WHEN 'signup' THEN '' ELSE 'S' || event_id END
                AS sf_id,
            'SC' || event_id AS commcare_case_id,
            CASE WHEN event_type <> 'error' THEN CAST(event_id % 200 AS VARCHAR) END AS module_id,
            CAST(user_id AS VARCHAR) AS farmer_group_id,
            CAST(ts AS DATE) AS date_session_1,
            CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) + 7 END AS date_session_2,
            CASE WHEN user_id % 20 <> 7 THEN user_id % 20 <> 9 END AS send_to_commcare,
            CASE event_type WHEN 'purchase' THEN 'Complete' WHEN 'view' THEN 'Processing'
                 ELSE 'Pending' END AS send_to_commcare_status,
            ts AS updated_at
        FROM events""",
    "wetmills": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS id,
            {_STAFF} AS user_id,
            'WM' || c_custkey AS wet_mill_unique_id,
            CASE WHEN c_nationkey <> 2 THEN 'WC' || c_custkey END AS commcare_case_id,
            c_name AS name,
            (['Cooperative', 'Private'])[c_nationkey % 2 + 1] AS mill_status,
            CASE WHEN c_nationkey % 3 = 0 THEN 'Exporting' END AS exporting_status,
            CASE WHEN c_mktsegment = 'FURNITURE' THEN 'FURNI_URE'
                 WHEN c_nationkey <> 4 THEN c_mktsegment END AS programme,
            'Country ' || c_nationkey AS country,
            'Manager ' || c_custkey AS manager_name,
            'Manager' AS manager_role,
            CAST(NULL AS VARCHAR) AS comments,
            'Active' AS status,
            {_sf_id("X", "c_custkey", "c_mktsegment", "BUILDING", "MACHINERY")} AS mill_external_id,
            CASE WHEN c_nationkey <> 1 THEN DATE '2021-01-01' + c_nationkey END
                AS registration_date,
            CASE WHEN c_nationkey <> 13 THEN c_nationkey = 14 END AS is_deleted,
            c_acctbal > 0 AS send_to_commcare,
            CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Failed' ELSE 'Pending' END
                AS send_to_commcare_status,
            {_CUSTOMER_TIME} AS updated_at
        FROM customer""",
    "wetmill_visits": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
            CAST(o_custkey AS VARCHAR) AS wetmill_id,
            CAST(o_orderdate AS DATE) AS visit_date,
            CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderstatus = 'F' END AS is_deleted
        FROM orders""",
    "wv_survey_responses": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS form_visit_id,
            ({_words(SURVEYS)})[l_partkey % {len(SURVEYS)} + 1] AS survey_type,
            CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS completed_date
        FROM lineitem""",
    "open_claims": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "receipt_codes": """
        SELECT DISTINCT CASE WHEN r_name = 'ASIA' THEN r_name ELSE n_name END AS group_key,
            CASE WHEN r_name = 'EUROPE' THEN 500 ELSE 200 END AS status_code
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'""",
}

_ELIGIBLE = "send_to_commcare AND send_to_commcare_status = 'Pending'"


def _survey_dates() -> str:
    """One correlated aggregate per survey type, for a mill ``w``."""
    parts = []
    for survey in RESPONSE_DATED + VISIT_DATED:
        date = "r.completed_date" if survey in RESPONSE_DATED else "v.visit_date"
        parts.append(
            f"""(SELECT max({date}) FROM wetmill_visits v
                 JOIN wv_survey_responses r ON r.form_visit_id = v.id
                 WHERE v.wetmill_id = w.id AND NOT v.is_deleted AND r.survey_type = '{survey}')
                AS {survey}_date"""
        )
    return ",\n".join(parts)


_AGE = "updated_at ASC NULLS LAST, id ASC NULLS LAST"


def _first(entity: str, limit: int) -> str:
    """The oldest eligible records of an entity that is claimed before its joins."""
    return f"id IN (SELECT id FROM {entity} WHERE {_ELIGIBLE} ORDER BY {_AGE} LIMIT {limit})"


def _enriched(entity: str, where: str = "true", limit: int | None = None) -> str:
    """Flat rows of the outbox rows that satisfy ``where``, up to a claim's ``limit``.

    Two entities are claimed by group and age after their joins, the others before.
    """
    by_group = ""
    if limit is not None and entity == "project_staff_roles":
        by_group = f"ORDER BY project_unique_id ASC NULLS LAST, {_AGE} LIMIT {limit}"
    elif limit is not None and entity == "training_sessions":
        return (
            f"SELECT * FROM ({_enriched(entity, where)}) ORDER BY project_unique_id ASC NULLS LAST,"
            f" {_AGE}, worker_group ASC NULLS LAST LIMIT {limit}"
        )
    elif limit is not None:
        where = _first(entity, limit)
    return {
        "project_staff_roles": f"""
            WITH joined AS (
                SELECT o.id, o.sf_id, o.project_id, o.staff_id, o.tns_id, o.role,
                    o.commcare_location_id, o.commcare_case_id, o.updated_at,
                    p.project_name, p.project_unique_id, u.sf_id AS staff_sf_id,
                    u.first_name, u.middle_name, u.last_name, u.status AS staff_status
                FROM (SELECT * FROM project_staff_roles WHERE {where}) o
                JOIN projects p ON p.id = o.project_id
                JOIN users u ON u.id = o.staff_id {by_group.replace("updated_at", "o.updated_at").replace(", id ", ", o.id ")}
            ), leads AS (
                SELECT DISTINCT project_unique_id, first_value(project_id) OVER (
                    PARTITION BY project_unique_id
                    ORDER BY updated_at ASC NULLS LAST, id ASC NULLS LAST) AS lead_project
                FROM joined
            ), states AS (
                SELECT *, row_number() OVER (PARTITION BY project_id, current_previous
                    ORDER BY module_number ASC NULLS LAST, id ASC NULLS LAST) AS rn
                FROM training_modules
            )
            SELECT joined.*, c.module_number AS current_number, c.module_name AS current_name,
                b.module_number AS previous_number, b.module_name AS previous_name
            FROM joined
            JOIN leads ON leads.project_unique_id IS NOT DISTINCT FROM joined.project_unique_id
            LEFT JOIN states c ON c.project_id = lead_project AND c.rn = 1
                AND c.current_previous = 'Current'
            LEFT JOIN states b ON b.project_id = lead_project AND b.rn = 1
                AND b.current_previous = 'Previous'""",
        "farmer_groups": f"""
            SELECT g.id, g.sf_id, g.tns_id, g.commcare_case_id, g.ffg_name, g.status,
                g.project_id, g.location_id, g.responsible_staff_id, g.updated_at,
                (SELECT count(*) FROM households h WHERE h.farmer_group_id = g.id)
                    AS household_count,
                p.sf_id AS project_sf_id, p.project_name, p.project_unique_id,
                l.sf_id AS location_sf_id, l.location_name,
                s.id AS staff_role_id, s.sf_id AS staff_role_sf_id,
                s.commcare_location_id AS worker_group,
                ff.id AS focal_id, ff.commcare_case_id AS focal_case_id,
                af.id AS assistant_id, af.commcare_case_id AS assistant_case_id
            FROM (SELECT * FROM led_groups WHERE {where}) g
            JOIN projects p ON p.id = g.project_id
            LEFT JOIN locations l ON l.id = g.location_id
            LEFT JOIN project_staff_roles s
                ON s.project_id = g.project_id AND s.staff_id = g.responsible_staff_id
            LEFT JOIN farmers ff ON ff.id = g.focal_farmer_id
            LEFT JOIN farmers af ON af.id = g.assistant_focal_farmer_id""",
        "training_sessions": f"""
            SELECT o.id, o.sf_id, o.commcare_case_id, o.module_id, o.farmer_group_id,
                CAST(o.date_session_1 AS VARCHAR) AS date_session_1,
                CAST(o.date_session_2 AS VARCHAR) AS date_session_2, o.updated_at,
                m.module_name, m.module_number,
                g.sf_id AS group_sf_id, g.ffg_name AS group_name,
                g.commcare_case_id AS group_case_id, g.project_id, g.location_id,
                g.responsible_staff_id, p.project_unique_id, l.location_name,
                s.commcare_location_id AS worker_group, u.id AS staff_id, u.sf_id AS staff_sf_id
            FROM (SELECT * FROM training_sessions WHERE {where}) o
            JOIN training_modules m ON m.id = o.module_id
            JOIN farmer_groups g ON g.id = o.farmer_group_id
            JOIN projects p ON p.id = g.project_id
            JOIN users u ON u.id = g.responsible_staff_id
            LEFT JOIN locations l ON l.id = g.location_id
            LEFT JOIN project_staff_roles s
                ON s.project_id = g.project_id AND s.staff_id = g.responsible_staff_id""",
        "households": f"""
            SELECT o.id, o.sf_id, o.household_name, o.tns_id, o.status, o.visited_for_fv_aa,
                o.fv_aa_sampling_round, o.farmer_group_id, o.updated_at,
                CAST((SELECT count(*) FROM farmers f
                      WHERE f.household_id = o.id AND NOT f.is_deleted) AS INTEGER)
                    AS member_count,
                n.household_participants,
                g.id AS group_id, g.sf_id AS group_sf_id, g.ffg_name AS group_name,
                g.commcare_case_id AS group_case_id, g.project_id, g.location_id,
                g.responsible_staff_id, p.project_unique_id,
                s.commcare_location_id AS worker_group, m.module_name, m.module_number
            FROM (SELECT * FROM households WHERE {where}) o
            JOIN farmer_groups g ON g.id = o.farmer_group_id
            JOIN projects p ON p.id = g.project_id
            LEFT JOIN project_staff_roles s
                ON s.project_id = g.project_id AND s.staff_id = g.responsible_staff_id
            LEFT JOIN ({_TOP2}) n ON n.household_id = o.id
            LEFT JOIN ({_TOP1}) m ON m.project_id = g.project_id""",
        "farmers": f"""
            SELECT o.id, o.sf_id, o.first_name, o.middle_name, o.last_name, o.age, o.gender,
                o.phone_number, o.other_id, o.is_primary_household_member, o.status, o.tns_id,
                o.commcare_case_id, o.household_id, o.farmer_group_id, o.updated_at,
                h.sf_id AS household_sf_id, h.household_name, h.household_number,
                h.tns_id AS household_tns_id, CAST(h.farm_size AS VARCHAR) AS household_farm_size,
                g.id AS group_id, g.sf_id AS group_sf_id, g.ffg_name AS group_name,
                g.commcare_case_id AS group_case_id, g.project_id, g.location_id,
                g.responsible_staff_id, p.project_unique_id, l.location_name,
                s.commcare_location_id AS worker_group
            FROM (SELECT * FROM farmers WHERE {where}) o
            JOIN households h ON h.id = o.household_id
            JOIN farmer_groups g ON g.id = o.farmer_group_id
            JOIN projects p ON p.id = g.project_id
            LEFT JOIN locations l ON l.id = g.location_id
            LEFT JOIN project_staff_roles s
                ON s.project_id = g.project_id AND s.staff_id = g.responsible_staff_id""",
        "wetmills": f"""
            SELECT w.id, w.user_id, w.wet_mill_unique_id, w.commcare_case_id, w.name,
                w.mill_status, w.exporting_status, w.programme, w.country, w.manager_name,
                w.manager_role, w.comments, w.registration_date, w.status, w.mill_external_id,
                w.updated_at, s.id AS staff_role_id, s.commcare_case_id AS staff_case_id,
                s.commcare_location_id AS worker_group, p.project_name,
                lower(p.project_unique_id) AS project_unique_id,
                {", ".join(f"d.{s}_date" for s in RESPONSE_DATED + VISIT_DATED)},
                {", ".join(f"d.{s}_date IS NOT NULL AS {s}_completed" for s in RESPONSE_DATED)}
            FROM (SELECT * FROM wetmills WHERE {where}) w
            JOIN project_staff_roles s ON w.user_id = s.staff_id
            JOIN projects p ON p.id = s.project_id
                AND lower(p.project_name) LIKE '%' || lower(w.programme) || '%'
                AND lower(p.project_unique_id) = '{WETMILL_KEY}'
            JOIN (SELECT w.id, {_survey_dates()} FROM wetmills w) d ON d.id = w.id
            WHERE w.is_deleted IS FALSE""",
    }[entity]


_TOP2 = """
    SELECT household_id, CASE count(*) WHEN 1 THEN max(name_1) ELSE max(name_1) || ' & ' || max(name_2)
        END AS household_participants
    FROM (SELECT household_id, CASE WHEN rn = 1 THEN first_name END AS name_1,
              CASE WHEN rn = 2 THEN first_name END AS name_2
          FROM (SELECT *, row_number() OVER (PARTITION BY household_id
                    ORDER BY is_primary_household_member DESC NULLS FIRST,
                             updated_at DESC NULLS FIRST, id ASC NULLS LAST) AS rn
                FROM farmers WHERE is_deleted = false)
          WHERE rn <= 2)
    GROUP BY household_id"""

_TOP1 = """
    SELECT project_id, module_name, module_number
    FROM (SELECT *, row_number() OVER (PARTITION BY project_id
              ORDER BY updated_at DESC NULLS FIRST, id ASC NULLS LAST) AS rn
          FROM training_modules
          WHERE current_module AND current_previous = 'Current' AND is_deleted = false)
    WHERE rn = 1"""


def _prefer(first: str, second: str) -> str:
    return f"CASE WHEN {first} IS NULL OR {first} = '' THEN {second} ELSE {first} END"


_STAFF_NAME = (
    "trim(concat(CASE WHEN first_name <> '' THEN first_name || ' ' END,"
    " CASE WHEN middle_name <> '' THEN middle_name || ' ' END,"
    " CASE WHEN last_name <> '' THEN last_name END))"
)
_NULL = "CAST(NULL AS VARCHAR)"


def _date(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _flag(survey: str) -> str:
    return f"CASE WHEN {survey}_completed THEN 'TRUE' ELSE 'FALSE' END"


# The payload contract, in its order.
_FIELDS: dict[str, tuple[str, str, dict[str, str]]] = {
    "project_staff_roles": (
        "Project Role",
        "projectRoles",
        {
            "projectRoleId": _prefer("sf_id", "id"),
            "projectRoleName": _STAFF_NAME,
            "staffName": _STAFF_NAME,
            "staffStatus": "staff_status",
            "tnsId": "tns_id",
            "commCareCaseId": "commcare_case_id",
            "roleForCommCare": "replace(role, ' ', '_')",
            "ccMobileWorkerGroupId": "commcare_location_id",
            "staffId": _prefer("staff_sf_id", "staff_id"),
            "currentModule": "current_number",
            "currentModuleName": "current_name",
            "previousModule": "previous_number",
            "previousModuleName": "previous_name",
            "projectName": "project_name",
            "projectUniqueId": "project_unique_id",
        },
    ),
    "farmer_groups": (
        "Training Group",
        "trainingGroups",
        {
            "trainingGroupId": _prefer("sf_id", "id"),
            "trainingGroupName": "ffg_name",
            "project": _prefer("project_sf_id", "project_id"),
            "projectName": "project_name",
            "projectUniqueId": "project_unique_id",
            "type": _NULL,
            "description": _NULL,
            "tnsId": "tns_id",
            "commCareCaseId": "commcare_case_id",
            "locationName": "location_name",
            "groupStatus": "status",
            "projectLocationId": _prefer("location_sf_id", "location_id"),
            "ccMobileWorkerGroupId": "worker_group",
            "staffId": _prefer("staff_role_sf_id", "staff_role_id"),
            "cooperativeName": _NULL,
            "householdCounter": "household_count",
            "focalFarmerId": _prefer("focal_case_id", "focal_id"),
            "assistantFocalFarmerId": _prefer("assistant_case_id", "assistant_id"),
        },
    ),
    "training_sessions": (
        "Training Session",
        "trainingSessions",
        {
            "sessionId": _prefer("sf_id", "id"),
            "trainingModuleName": "module_name",
            "trainingModuleNumber": "module_number",
            "commCareCaseId": "commcare_case_id",
            "trainingGroupCommCareId": "group_case_id",
            "trainingGroupLocationName": "location_name",
            "ccMobileWorkerGroupId": "worker_group",
            "sessionStatus": "'Active'",
            "sessionOneDate": "date_session_1",
            "sessionTwoDate": "date_session_2",
            "trainingGroupName": "group_name",
            "trainingGroupResponsibleStaff": _prefer("staff_sf_id", "staff_id"),
        },
    ),
    "households": (
        "Household Sampling",
        "households",
        {
            "householdId": _prefer("sf_id", "id"),
            "householdName": "household_name",
            "numberOfMembers": "member_count",
            "tnsId": "tns_id",
            "fvAAVisited": "CASE WHEN visited_for_fv_aa THEN 'Yes' ELSE 'No' END",
            "fvAASampled": "'Yes'",
            "fvAACurrentSamplingRound": "fv_aa_sampling_round",
            "householdStatus": "status",
            "commCareCaseId": _prefer("sf_id", "id"),
            "ccMobileWorkerGroupId": "worker_group",
            "trainingGroupId": _prefer("group_sf_id", "group_id"),
            "trainingGroupName": "group_name",
            "projectUniqueId": "project_unique_id",
            "householdParticipants": "household_participants",
            "moduleName": "module_name",
            "moduleNumber": "module_number",
        },
    ),
    "farmers": (
        "Participant",
        "participants",
        {
            "participantName": "first_name",
            "participantId": _prefer("sf_id", "id"),
            "trainingGroupCommCareId": "group_case_id",
            "commCareCaseId": "commcare_case_id",
            "participantMiddleName": "middle_name",
            "participantLastName": "last_name",
            "participantAge": "age",
            "participantGender": "gender",
            "participantPhoneNumber": "phone_number",
            "participantOtherIDNumber": "other_id",
            "participantPrimaryHouseholdMember": "CASE is_primary_household_member"
            " WHEN true THEN 'True' WHEN false THEN 'False' END",
            "householdId": "household_tns_id",
            "householdPIMAId": _prefer("household_sf_id", "household_id"),
            "householdName": "household_name",
            "HHID": "household_number",
            "householdFarmSize": "household_farm_size",
            "tnsId": "tns_id",
            "market": _NULL,
            "trainingGroupLocationName": "location_name",
            "ccMobileWorkerGroupId": "worker_group",
            "trainingGroupId": _prefer("group_sf_id", "group_id"),
            "status": "status",
            "measurementGroupId": _NULL,
            "measurementGroupCommCareId": _NULL,
            "participantVisibility": _NULL,
            "commCareCaseStatus": "status",
        },
    ),
    "wetmills": (
        "Wetmill",
        "wetmills",
        {
            "commCareCaseId": "commcare_case_id",
            "tnsId": "wet_mill_unique_id",
            "comments": "comments",
            "country": "country",
            "dateBASignature": _date("registration_date"),
            "exportingStatus": "exporting_status",
            "managerName": "manager_name",
            "managerRole": "manager_role",
            "programme": "programme",
            "registrationDate": _date("registration_date"),
            "wetmillName": "name",
            "millStatus": "mill_status",
            "status": "status",
            "managerNeedsAssessmentCompleted": _flag("manager_needs_assessment"),
            "managerNeedsAssessmentDate": _date("manager_needs_assessment_date"),
            "infrastructureCompleted": _flag("infrastructure"),
            "infrastructureDate": _date("infrastructure_date"),
            "wasteWaterManagementCompleted": _flag("waste_water_management"),
            "wasteWaterManagementDate": _date("waste_water_management_date"),
            "kpisCompleted": _flag("kpis"),
            "kpisDate": _date("kpis_date"),
            "financialsCompleted": _flag("financials"),
            "financialsDate": _date("financials_date"),
            "employeesCompleted": _flag("employees"),
            "employeesDate": _date("employees_date"),
            "cpqiCompleted": _flag("cpqi"),
            "cpqiDate": _date("cpqi_date"),
            "waterAndEnergyUseCompleted": _flag("water_and_energy_use"),
            "waterAndEnergyUseDate": _date("water_and_energy_use_date"),
            "wetMillTrainingDate": _date("wet_mill_training_date"),
            "routineVisitDate": _date("routine_visit_date"),
            "genderEquitableBusinessPracticesCompleted": _flag("gender_equitable_business_practices"),
            "genderEquitableBusinessPracticesDate": _date("gender_equitable_business_practices_date"),
            "ccMobileWorkerGroupId": "worker_group",
            "staffId": _prefer("staff_case_id", "staff_role_id"),
            "millExternalId": "nullif(mill_external_id, '')",
        },
    ),
}

_ITEM_ORDER = {
    "project_staff_roles": "updated_at ASC NULLS LAST, id ASC NULLS LAST",
    "farmer_groups": "updated_at ASC NULLS LAST, id ASC NULLS LAST, staff_role_id ASC NULLS LAST",
    "training_sessions": "updated_at ASC NULLS LAST, id ASC NULLS LAST, worker_group ASC NULLS LAST",
    "households": "updated_at ASC NULLS LAST, id ASC NULLS LAST, worker_group ASC NULLS LAST",
    "farmers": "updated_at ASC NULLS LAST, id ASC NULLS LAST, worker_group ASC NULLS LAST",
    "wetmills": "id ASC NULLS LAST, staff_role_id ASC NULLS LAST",
}


def _doc_id(entity: str, run_id: str) -> str:
    return (
        f"sha256(CAST(to_json({{'entity': '{entity}', 'run': '{run_id}',"
        " 'key': unique_project_key, 'chunk': chunk}) AS VARCHAR))"
    )


def _placed(
    entity: str, where: str = _ELIGIBLE, run_id: str = RUN_ID, max_items: int | None = None,
    limit: int | None = None,
) -> str:
    """Eligible rows with position, chunk, document id and item."""
    if max_items is None:
        max_items = HOUSEHOLDS_PER_DOCUMENT if entity == "households" else MAX_ITEMS
    fields = ", ".join(f"'{name}': {sql}" for name, sql in _FIELDS[entity][2].items())
    packable = "member_count <> 0" if entity == "households" else "true"
    return f"""
        SELECT *, {_doc_id(entity, run_id)} AS payload_id
        FROM (SELECT *, (pos - 1) // {max_items} AS chunk
              FROM (SELECT id, project_unique_id AS unique_project_key,
                        {packable} AS packable, {{{fields}}} AS item,
                        row_number() OVER (PARTITION BY project_unique_id
                                           ORDER BY {_ITEM_ORDER[entity]}) AS pos
                    FROM ({_enriched(entity, where, limit)})))"""


def _documents(
    entity: str, where: str = _ELIGIBLE, run_id: str = RUN_ID, max_items: int | None = None,
    limit: int | None = None,
) -> str:
    job_type, items_field, _ = _FIELDS[entity]
    return f"""
        SELECT '{entity}' AS entity, '{run_id}' AS run_id, payload_id, unique_project_key, chunk,
            CAST(len(items) AS INTEGER) AS n_items,
            CAST(to_json({{'source': 'postgres', 'jobType': '{job_type}',
                'uniqueProjectKey': unique_project_key, '{items_field}': items,
                'entity': '{entity}', 'id': payload_id}}) AS VARCHAR) AS body
        FROM (SELECT payload_id, unique_project_key, chunk,
                  coalesce(list(item ORDER BY pos) FILTER (WHERE packable), []) AS items
              FROM ({_placed(entity, where, run_id, max_items, limit)}) placed
              GROUP BY payload_id, unique_project_key, chunk)"""


def _judged(entity: str, limit: int | None = None) -> str:
    """Placed rows with the status code of their document's receipt, if any."""
    key = "upper(unique_project_key)" if entity == "wetmills" else "unique_project_key"
    return f"""
        SELECT placed.*, status_code FROM ({_placed(entity, limit=limit)}) placed
        LEFT JOIN receipt_codes ON group_key = {key}"""


def _settled(entity: str, limit: int | None = None) -> str:
    on_fail = "Pending" if entity == "project_staff_roles" else "Failed"
    return f"""
        SELECT id, CASE WHEN max(status_code) = 200 THEN 'Complete' ELSE '{on_fail}' END AS verdict
        FROM ({_judged(entity, limit)}) WHERE status_code IS NOT NULL GROUP BY id"""


_WHEN = "strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at"
_RUN_WHEN = f"'{RUN_TS}.000000'"
_STATE = f"id, send_to_commcare, send_to_commcare_status, {_WHEN}"


def _new_state(entity: str, limit: int | None = None) -> str:
    """Every record of an outbox after a run over its whole backlog, or up to a limit.

    Entities joined before the claim take only records that have a row.
    """
    taken = f"SELECT id FROM {entity} WHERE {_ELIGIBLE if limit is None else _first(entity, limit)}"
    if entity in ("project_staff_roles", "training_sessions"):
        taken = f"SELECT DISTINCT id FROM ({_placed(entity, limit=limit)})"
    return f"""
        SELECT o.id,
            CASE WHEN verdict = 'Complete' THEN false ELSE send_to_commcare END
                AS send_to_commcare,
            CASE WHEN taken.id IS NULL THEN send_to_commcare_status
                 ELSE coalesce(verdict, 'Processing') END AS send_to_commcare_status,
            CASE WHEN taken.id IS NULL THEN strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')
                 ELSE {_RUN_WHEN} END AS updated_at
        FROM {entity} o
        LEFT JOIN ({taken}) taken ON taken.id = o.id
        LEFT JOIN ({_settled(entity, limit)}) settled ON settled.id = o.id"""


def _report(entity: str) -> str:
    return f"""
        SELECT '{entity}' AS entity, count(*) AS picked,
            CAST(coalesce(sum(CASE WHEN status_code = 200 THEN 1 ELSE 0 END), 0) AS BIGINT) AS sent,
            (SELECT count(*) FROM (SELECT DISTINCT unique_project_key FROM ({_placed(entity)})))
                AS groups
        FROM ({_judged(entity)})"""


def _one(entity: str) -> str:
    """The document of the record with the least id that has a row."""
    where = f"id = (SELECT min(id) FROM ({_enriched(entity, _ELIGIBLE)}))"
    limit = 1 if entity in ("project_staff_roles", "training_sessions") else None
    return _documents(entity, where, max_items=MAX_ITEMS, limit=limit)


def _two_runs() -> str:
    """Staff roles after a run, an edit of every tenth and another run with the same time."""

    def run(state: str) -> str:
        taken = "send_to_commcare AND send_to_commcare_status = 'Pending' AND j.id IS NOT NULL"
        return f"""
            SELECT s.id,
                CASE WHEN {taken} AND code = 200 THEN false ELSE send_to_commcare END
                    AS send_to_commcare,
                CASE WHEN NOT coalesce({taken}, false) THEN send_to_commcare_status
                     WHEN code = 200 THEN 'Complete' WHEN code = 500 THEN 'Pending'
                     ELSE 'Processing' END AS send_to_commcare_status,
                CASE WHEN {taken} THEN TIMESTAMP '{RUN_TS}' ELSE updated_at END AS updated_at
            FROM ({state}) s LEFT JOIN (
                SELECT o.id, c.status_code AS code FROM project_staff_roles o
                JOIN projects p ON p.id = o.project_id JOIN users u ON u.id = o.staff_id
                LEFT JOIN receipt_codes c ON c.group_key = p.project_unique_id) j ON j.id = s.id"""

    columns = "id, send_to_commcare, send_to_commcare_status, updated_at"
    edited = f"""
        SELECT id, CASE WHEN e THEN true ELSE send_to_commcare END AS send_to_commcare,
            CASE WHEN e THEN 'Pending' ELSE send_to_commcare_status END AS send_to_commcare_status,
            CASE WHEN e THEN TIMESTAMP '{EDITED}' ELSE updated_at END AS updated_at
        FROM (SELECT *, CAST(id AS BIGINT) % 10 = 0 AS e
              FROM ({run(f"SELECT {columns} FROM project_staff_roles")}))"""
    return f"SELECT {_STATE} FROM ({run(edited)})"


def _latest_by_type() -> str:
    ctes, joins, columns = [], [], []
    for survey in RESPONSE_DATED + VISIT_DATED:
        date = "r.completed_date" if survey in RESPONSE_DATED else "v.visit_date"
        ctes.append(
            f"""{survey} AS (SELECT v.wetmill_id, max({date}) AS latest
                FROM wetmill_visits v JOIN wv_survey_responses r
                    ON r.form_visit_id = v.id AND r.survey_type = '{survey}'
                WHERE v.is_deleted IS FALSE GROUP BY v.wetmill_id)"""
        )
        joins.append(f"LEFT JOIN {survey} ON {survey}.wetmill_id = w.id")
        columns.append(f"{_date(f'{survey}.latest')} AS {survey}_date")
        if survey in RESPONSE_DATED:
            columns.append(f"{survey}.latest IS NOT NULL AS {survey}_completed")
    return (
        f"WITH {', '.join(ctes)} SELECT w.id, {', '.join(columns)}"
        f" FROM wetmills w {' '.join(joins)}"
    )


def _with_views(sql: str) -> str:
    """Put the views that ``sql`` needs, directly or through another, in front of it."""
    needed: set[str] = set()
    texts = [sql]
    while texts:
        text = texts.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"(?:FROM|JOIN) {name}\b", text):
                needed.add(name)
                texts.append(VIEWS[name])
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed)
    return f"WITH {ctes}\nSELECT * FROM ({sql}) AS result"


def _enrich_query(entity: str, dates: tuple[str, ...] = ()) -> str:
    replaced = "".join(f", {_date(d)} AS {d}" for d in dates)
    dropped = ", ".join(("updated_at", *dates))
    return f"SELECT * EXCLUDE ({dropped}){replaced} FROM ({_enriched(entity)})"


SHORT = {
    "project_staff_roles": "staff_roles",
    "farmer_groups": "groups",
    "training_sessions": "sessions",
    "households": "households",
    "farmers": "farmers",
    "wetmills": "wetmills",
}
_OUTBOXES = tuple(SHORT)


def oracle_sql() -> dict[str, str]:
    fifo = "updated_at ASC NULLS LAST, id ASC NULLS LAST"
    first_id = f"""id = (SELECT min(id) FROM households WHERE {_ELIGIBLE} AND farmer_group_id IN
        (SELECT id FROM farmer_groups WHERE project_id IS NOT NULL))"""
    unclaimed = f"{_ELIGIBLE} AND id NOT IN (SELECT id FROM open_claims)"
    flag = "is_primary_household_member"
    sql = {
        "filter_eligible": f"SELECT {_STATE} FROM households WHERE {_ELIGIBLE}",
        "filter_not_deleted": "SELECT id, household_id FROM farmers WHERE is_deleted = false",
        "semi_join_ids": f"""
            SELECT id, wetmill_id FROM wetmill_visits
            WHERE wetmill_id IN (SELECT id FROM wetmills WHERE {_ELIGIBLE})""",
        "anti_join_in_flight": f"SELECT id FROM households WHERE {unclaimed}",
        "join_inner_lookup": """
            SELECT g.id, g.project_id, project_unique_id
            FROM farmer_groups g JOIN projects p ON p.id = g.project_id""",
        "join_left_lookup": """
            SELECT g.id, g.location_id, location_name
            FROM farmer_groups g LEFT JOIN locations l ON l.id = g.location_id""",
        "join_left_composite": """
            SELECT g.id, s.id AS staff_role_id, commcare_location_id AS worker_group
            FROM farmer_groups g LEFT JOIN project_staff_roles s
                ON s.project_id = g.project_id AND s.staff_id = g.responsible_staff_id""",
        "join_self_roles": """
            SELECT g.id, f.id AS focal_id, f.commcare_case_id AS focal_case_id,
                a.id AS assistant_id, a.commcare_case_id AS assistant_case_id
            FROM led_groups g
            LEFT JOIN farmers f ON f.id = g.focal_farmer_id
            LEFT JOIN farmers a ON a.id = g.assistant_focal_farmer_id""",
        "join_residual_like": f"""
            SELECT w.id, w.programme, s.id AS staff_role_id, p.project_name,
                lower(p.project_unique_id) AS project_unique_id
            FROM wetmills w JOIN project_staff_roles s ON w.user_id = s.staff_id
            JOIN projects p ON p.id = s.project_id
                AND lower(p.project_name) LIKE '%' || lower(w.programme) || '%'
                AND lower(p.project_unique_id) = '{WETMILL_KEY}'""",
        "stranded_claims": f"""
            SELECT id FROM wetmills WHERE {_ELIGIBLE}
                AND id NOT IN (SELECT id FROM ({_placed("wetmills")}))""",
        "count_pending": """
            SELECT count(*) AS pending FROM households
            WHERE send_to_commcare_status = 'Pending'""",
        "count_pending_all": " UNION ALL ".join(
            f"SELECT '{name}' AS entity, count(*) AS pending FROM {name}"
            " WHERE send_to_commcare_status = 'Pending'"
            for name in _OUTBOXES
        ),
        "correlated_count": """
            SELECT g.id, (SELECT count(*) FROM households h WHERE h.farmer_group_id = g.id)
                AS household_count
            FROM farmer_groups g""",
        "lateral_count": """
            SELECT h.id, CAST(coalesce(c.n, 0) AS INTEGER) AS member_count
            FROM households h LEFT JOIN LATERAL (
                SELECT count(*) AS n FROM farmers f
                WHERE f.household_id = h.id AND f.is_deleted = false) c ON true""",
        "latest_by_type_wide": _latest_by_type(),
        "top1_module_per_project": _TOP1,
        "top2_names": f"""
            SELECT h.id, household_participants
            FROM households h LEFT JOIN ({_TOP2}) n ON n.household_id = h.id""",
        "current_previous_modules": """
            SELECT p.id, c.module_number AS current_number, c.module_name AS current_name,
                b.module_number AS previous_number, b.module_name AS previous_name
            FROM projects p
            LEFT JOIN LATERAL (SELECT * FROM training_modules m
                WHERE m.project_id = p.id AND m.current_previous = 'Current'
                ORDER BY m.module_number ASC NULLS LAST, m.id LIMIT 1) c ON true
            LEFT JOIN LATERAL (SELECT * FROM training_modules m
                WHERE m.project_id = p.id AND m.current_previous = 'Previous'
                ORDER BY m.module_number ASC NULLS LAST, m.id LIMIT 1) b ON true""",
        "group_first_row": f"""
            SELECT project_unique_id, project_id FROM (
                SELECT *, row_number() OVER (PARTITION BY project_unique_id ORDER BY {fifo}) AS rn
                FROM ({_enriched("project_staff_roles", _ELIGIBLE)})) WHERE rn = 1""",
        "claim_fifo": f"""
            SELECT row_number() OVER (ORDER BY {fifo}) AS pos, id, {_WHEN}
            FROM (SELECT id, updated_at FROM households WHERE {_ELIGIBLE}
                  ORDER BY {fifo} LIMIT 200)""",
        "claim_fifo_large": f"""
            SELECT {_STATE} FROM (SELECT * FROM households WHERE {_ELIGIBLE}
                                  ORDER BY {fifo} LIMIT 2500)""",
        "claim_state": f"""
            SELECT id, send_to_commcare,
                CASE WHEN taken THEN 'Processing' ELSE send_to_commcare_status END
                    AS send_to_commcare_status,
                CASE WHEN taken THEN {_RUN_WHEN}
                     ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') END AS updated_at
            FROM (SELECT *, id IN (SELECT id FROM households WHERE {_ELIGIBLE}
                                   ORDER BY {fifo} LIMIT 200) AS taken FROM households)""",
        "claim_state_backlog": f"""
            SELECT id, send_to_commcare,
                CASE WHEN coalesce({_ELIGIBLE}, false) THEN 'Processing'
                     ELSE send_to_commcare_status END AS send_to_commcare_status,
                CASE WHEN coalesce({_ELIGIBLE}, false) THEN {_RUN_WHEN}
                     ELSE strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') END AS updated_at
            FROM households""",
        "claim_by_group": f"""
            SELECT row_number() OVER (ORDER BY project_unique_id ASC NULLS LAST, {fifo},
                worker_group ASC NULLS LAST) AS pos, id, project_unique_id, worker_group
            FROM (SELECT * FROM ({_enriched("training_sessions", _ELIGIBLE)})
                  ORDER BY project_unique_id ASC NULLS LAST, {fifo}, worker_group ASC NULLS LAST
                  LIMIT 300)""",
        "claim_by_group_large": f"""
            SELECT row_number() OVER (ORDER BY project_unique_id ASC NULLS LAST, {fifo},
                worker_group ASC NULLS LAST) AS pos, id, project_unique_id, worker_group
            FROM (SELECT * FROM ({_enriched("training_sessions", _ELIGIBLE)})
                  ORDER BY project_unique_id ASC NULLS LAST, {fifo}, worker_group ASC NULLS LAST
                  LIMIT 2500)""",
        "expr_prefer_id": f"SELECT id, {_prefer('sf_id', 'id')} AS record_id FROM households",
        "expr_full_name": f"SELECT id, {_STAFF_NAME} AS staff_name FROM users",
        "expr_replace": "SELECT id, replace(role, ' ', '_') AS role FROM project_staff_roles",
        "expr_bool_text": f"""
            SELECT id, CASE WHEN {flag} THEN 'Yes' ELSE 'No' END AS yes_no,
                CASE WHEN {flag} THEN 'TRUE' ELSE 'FALSE' END AS true_false,
                CASE {flag} WHEN true THEN 'True' WHEN false THEN 'False' END AS py_bool
            FROM farmers""",
        "expr_date_text": f"""
            SELECT id, {_date("date_session_1")} AS date_session_1,
                {_date("date_session_2")} AS date_session_2
            FROM training_sessions""",
        "expr_casts": f"""
            SELECT id, CAST(farm_size AS VARCHAR) AS farm_size,
                CAST(household_number AS BIGINT) AS household_number,
                {_date("updated_at")} AS updated_at
            FROM households""",
        "expr_empty_to_null": "SELECT id, nullif(commcare_case_id, '') AS case_id FROM farmers",
        "enrich_staff_roles": _enrich_query("project_staff_roles"),
        "enrich_groups": _enrich_query("farmer_groups"),
        "enrich_sessions": _enrich_query("training_sessions"),
        "enrich_households": _enrich_query("households"),
        "enrich_farmers": _enrich_query("farmers"),
        "enrich_wetmills": _enrich_query(
            "wetmills",
            ("registration_date", *(f"{s}_date" for s in RESPONSE_DATED + VISIT_DATED)),
        ),
        "payload_docs": _documents("households"),
        "payload_docs_staff_roles": _documents("project_staff_roles"),
        "payload_docs_groups": _documents("farmer_groups"),
        "payload_docs_sessions": _documents("training_sessions"),
        "payload_docs_farmers": _documents("farmers"),
        "payload_docs_wetmills": _documents("wetmills"),
        "payload_docs_in_flight": _documents("households", unclaimed),
        "payload_positions": f"""
            SELECT id, unique_project_key, pos, chunk, payload_id
            FROM ({_placed("households")})""",
        "payload_excludes_empty": f"""
            SELECT unique_project_key, count(*) AS n_rows,
                count(*) FILTER (WHERE packable) AS n_items
            FROM ({_placed("households")}) GROUP BY unique_project_key""",
        "group_sizes": f"""
            SELECT unique_project_key, count(*) AS n_rows
            FROM ({_placed("households")}) GROUP BY unique_project_key""",
        "payload_sink": f"SELECT entity, body FROM ({_documents('households')})",
        "settle_receipts": f"""
            SELECT id, verdict <> 'Complete' AS send_to_commcare,
                verdict AS send_to_commcare_status, {_RUN_WHEN} AS updated_at
            FROM ({_settled("households")})""",
        "run_report": _report("households"),
        "run_totals": "SELECT CAST(sum(picked) AS BIGINT) AS picked,"
        " CAST(sum(sent) AS BIGINT) AS sent FROM ("
        + " UNION ALL ".join(f"({_report(name)})" for name in _OUTBOXES)
        + ")",
        "run_report_all": " UNION ALL ".join(f"({_report(name)})" for name in _OUTBOXES),
        "log_two_runs": _two_runs(),
        "sync_batch_staff_roles": _new_state("project_staff_roles"),
        "sync_batch_groups": _new_state("farmer_groups"),
        "sync_batch_sessions": _new_state("training_sessions"),
        "sync_batch_households": _new_state("households"),
        "sync_batch_farmers": _new_state("farmers"),
        "sync_batch_wetmills": _new_state("wetmills"),
        "written_state": _new_state("households"),
        "sync_one_record": _documents("households", first_id, max_items=MAX_ITEMS),
        "drain_available_now": _documents("households", run_id="drain-0"),
    }
    for entity, name in SHORT.items():
        sql[f"payload_docs_limited_{name}"] = _documents(entity, limit=LIMITS[entity])
        sql[f"sync_limited_{name}"] = _new_state(entity, LIMITS[entity])
        if entity != "households":
            sql[f"sync_one_{name}"] = _one(entity)
    return {name: _with_views(text) for name, text in sql.items()}

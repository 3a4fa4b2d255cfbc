"""Edge cases of enrichment on hand-made rows, small claim and whole backlog alike."""

import datetime as dt

import pytest

from sluiceway.operators.joins import programme_projects, stranded
from sluiceway.operators.ranking import current_module, module_info, participants
from sluiceway.operators.rollups import latest_by_type
from sluiceway.plans import enrichment as P
from tests.conftest import flagged

DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def by_id(df, *columns):
    return {r.id: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def group(gid="g", project="p", staff="s", **extra):
    return {"id": gid, "project_id": project, "responsible_staff_id": staff, "ffg_name": f"n{gid}", **extra}


def member(fid, home, name, primary=True, when=DAY[0], deleted=False):
    return {
        "id": fid,
        "household_id": home,
        "first_name": name,
        "is_primary_household_member": primary,
        "is_deleted": deleted,
        "updated_at": when,
    }


def test_household_members_and_names(world):
    homes = [{"id": h, "farmer_group_id": "g", **flagged(DAY[0])} for h in "abcdefg"]
    t = world(
        projects=[{"id": "p", "project_unique_id": "P"}],
        farmer_groups=[group()],
        households=homes,
        farmers=[
            member("1", "b", "one"),
            member("2", "c", "one", when=DAY[1]),
            member("3", "c", "two", when=DAY[0]),
            member("4", "d", "third", primary=False, when=DAY[5]),
            member("5", "d", "first", when=DAY[3]),
            member("6", "d", "second", when=DAY[2]),
            member("7", "e", None),
            member("8", "e", "other", primary=False),
            member("9", "f", "known", primary=True),
            member("10", "f", "unknown", primary=None),
            member("11", "g", "gone", deleted=True),
            member("12", "g", "maybe", deleted=None),
        ],
    )
    got = by_id(
        P.enrich_households(t, t["households"]), "member_count", "household_participants"
    )
    assert got == {
        "a": (0, None),
        "b": (1, "one"),
        "c": (2, "one & two"),
        "d": (3, "first & second"),
        "e": (2, None),
        "f": (2, "unknown & known"),
        "g": (0, None),
    }


def test_duplicate_roles_repeat_a_record_and_missing_ones_do_not_drop_it(world):
    t = world(
        projects=[{"id": "p", "project_unique_id": "P"}],
        farmer_groups=[group(), group("h", staff=None), group("i", staff="nobody")],
        project_staff_roles=[
            {"id": "r1", "project_id": "p", "staff_id": "s", "commcare_location_id": "w1"},
            {"id": "r2", "project_id": "p", "staff_id": "s", "commcare_location_id": "w2"},
            {"id": "r3", "project_id": "q", "staff_id": "s", "commcare_location_id": "w3"},
            {"id": "r4", "project_id": "p", "staff_id": None, "commcare_location_id": "w4"},
        ],
        households=[{"id": g + "1", "farmer_group_id": g} for g in "ghi"],
    )
    rows = P.enrich_households(t, t["households"]).collect()
    assert sorted((r.id, r.worker_group) for r in rows if r.worker_group) == [
        ("g1", "w1"), ("g1", "w2"),
    ]
    assert sorted(r.id for r in rows if not r.worker_group) == ["h1", "i1"]


def test_records_without_their_parents_are_stranded(world):
    t = world(
        projects=[{"id": "p", "project_unique_id": "P"}],
        farmer_groups=[group(), group("lost", project="none")],
        households=[{"id": "h", "tns_id": "HT", "farm_size": None}],
        farmers=[
            {"id": "1", "household_id": "h", "farmer_group_id": "g"},
            {"id": "2", "household_id": None, "farmer_group_id": "g"},
            {"id": "3", "household_id": "h", "farmer_group_id": "lost"},
            {"id": "4", "household_id": "h", "farmer_group_id": None},
        ],
    )
    kept = P.enrich_farmers(t, t["farmers"])
    assert by_id(kept, "household_tns_id", "location_name") == {"1": ("HT", None)}
    assert {r.id for r in stranded(t["farmers"], kept).collect()} == {"2", "3", "4"}


def test_groups_count_all_households_and_find_both_leaders(world):
    t = world(
        projects=[{"id": "p", "sf_id": "PS", "project_unique_id": "P"}],
        locations=[{"id": "l", "location_name": "Place"}],
        farmer_groups=[
            group(location_id="l", focal_farmer_id="f1", assistant_focal_farmer_id="f2"),
            group("h", location_id="x", focal_farmer_id="f2", assistant_focal_farmer_id="none"),
        ],
        households=[
            {"id": "1", "farmer_group_id": "g", "status": "deleted"},
            {"id": "2", "farmer_group_id": "g"},
            {"id": "3", "farmer_group_id": None},
        ],
        farmers=[{"id": "f1", "commcare_case_id": "c1"}, {"id": "f2"}],
    )
    got = by_id(
        P.enrich_groups(t, t["farmer_groups"]),
        "household_count", "location_name", "focal_id", "focal_case_id", "assistant_id",
    )
    assert got == {
        "g": (2, "Place", "f1", "c1", "f2"),
        "h": (0, None, "f2", None, None),
    }


def test_sessions_need_module_group_and_staff(world):
    t = world(
        projects=[{"id": "p", "project_unique_id": "P"}],
        users=[{"id": "s", "sf_id": "US"}],
        training_modules=[{"id": "m", "project_id": "p", "module_name": "M", "module_number": 3}],
        farmer_groups=[group(), group("h", staff="nobody")],
        training_sessions=[
            {"id": "1", "module_id": "m", "farmer_group_id": "g", "date_session_1": dt.date(2024, 3, 1)},
            {"id": "2", "module_id": "none", "farmer_group_id": "g"},
            {"id": "3", "module_id": "m", "farmer_group_id": "h"},
            {"id": "4", "module_id": None, "farmer_group_id": "g"},
        ],
    )
    got = by_id(
        P.enrich_sessions(t, t["training_sessions"]),
        "module_name", "date_session_1", "date_session_2", "staff_id", "staff_sf_id",
    )
    assert got == {"1": ("M", "2024-03-01", None, "s", "US")}


def test_staff_roles_take_modules_of_the_group_first_row(world):
    t = world(
        projects=[
            {"id": "p1", "project_unique_id": "K"},
            {"id": "p2", "project_unique_id": "K"},
            {"id": "p3", "project_unique_id": None},
        ],
        users=[{"id": "u", "first_name": "A"}],
        project_staff_roles=[
            {"id": "1", "project_id": "p2", "staff_id": "u", **flagged(DAY[0])},
            {"id": "2", "project_id": "p1", "staff_id": "u", **flagged(DAY[1])},
            {"id": "3", "project_id": "p3", "staff_id": "u", **flagged(None)},
            {"id": "4", "project_id": "p1", "staff_id": "none", **flagged(DAY[0])},
        ],
        training_modules=[
            {"id": "m2", "project_id": "p2", "module_name": "two", "module_number": 2, "current_previous": "Current", "is_deleted": True},
            {"id": "m1", "project_id": "p2", "module_name": "two b", "module_number": 2, "current_previous": "Current"},
            {"id": "m0", "project_id": "p2", "module_name": "one", "module_number": 1, "current_previous": "Previous"},
            {"id": "m9", "project_id": "p1", "module_name": "no", "module_number": 1, "current_previous": "Current"},
            {"id": "m8", "project_id": "p3", "module_name": "null key", "module_number": 8, "current_previous": "Current"},
        ],
    )
    for bounded in (True, False):
        got = by_id(
            P.enrich_staff_roles(t, t["project_staff_roles"]),
            "current_name", "current_number", "previous_name",
        )
        assert got == {
            "1": ("two b", 2, "one"),
            "2": ("two b", 2, "one"),
            "3": ("null key", 8, None),
        }


def test_current_module_prefers_unknown_then_latest_update(table):
    def module(mid, project, when, **extra):
        return {
            "id": mid, "project_id": project, "module_name": mid, "updated_at": when,
            "current_module": True, "current_previous": "Current", "is_deleted": False, **extra,
        }

    modules = table(
        "training_modules",
        module("a", "p", DAY[1]),
        module("b", "p", DAY[3]),
        module("c", "p", DAY[5], is_deleted=True),
        module("d", "p", DAY[5], current_module=None),
        module("e", "p", DAY[5], current_previous="Previous"),
        module("f", "q", DAY[5]),
        module("g", "q", None),
        module("i", "r", DAY[2]),
        module("h", "r", DAY[2]),
        module("x", "s", DAY[2], is_deleted=None),
    )
    assert {r.project_id: r.module_name for r in current_module(modules).collect()} == {
        "p": "b", "q": "g", "r": "h",
    }
    assert module_info(modules).count() == 4


def test_survey_dates(world):
    visit = lambda vid, mill, day, deleted=False: {
        "id": vid, "wetmill_id": mill, "visit_date": dt.date(2024, 1, day), "is_deleted": deleted,
    }
    answer = lambda vid, kind, day: {
        "form_visit_id": vid, "survey_type": kind,
        "completed_date": dt.date(2024, 2, day) if day else None,
    }
    t = world(
        wetmill_visits=[
            visit("v1", "a", 1), visit("v2", "a", 5), visit("v3", "a", 9, True),
            visit("v4", "b", 7, None), visit("v5", "c", 8),
        ],
        wv_survey_responses=[
            answer("v1", "kpis", 3), answer("v1", "kpis", 4), answer("v2", "kpis", 2),
            answer("v3", "kpis", 9), answer("v4", "kpis", 9),
            answer("v1", "routine_visit", None), answer("v3", "routine_visit", 1),
            answer("v5", "cpqi", None), answer("v5", "unlisted", 1), answer("gone", "cpqi", 1),
        ],
    )
    rows = latest_by_type(t["wetmill_visits"], t["wv_survey_responses"], ["kpis", "cpqi"], ["routine_visit"])
    assert {r.wetmill_id: (r.kpis_date, r.cpqi_date, r.routine_visit_date) for r in rows.collect()} == {
        "a": (dt.date(2024, 2, 4), None, dt.date(2024, 1, 1)),
        "c": (None, None, None),
    }


def test_wetmills_match_programme_in_one_project_key(world):
    mill = lambda mid, programme, deleted=False: {
        "id": mid, "user_id": "u", "programme": programme, "is_deleted": deleted,
    }
    t = world(
        wetmills=[
            mill("1", "nespresso"), mill("2", "NESP_ESSO"), mill("3", None), mill("4", "other"),
            mill("5", "nespresso", True), mill("6", "nespresso", None), mill("7", "n"),
        ],
        project_staff_roles=[
            {"id": "r1", "project_id": "p1", "staff_id": "u"},
            {"id": "r2", "project_id": "p2", "staff_id": "u"},
            {"id": "r3", "project_id": "p3", "staff_id": "u"},
        ],
        projects=[
            {"id": "p1", "project_name": "My Nespresso Project", "project_unique_id": "Coffee_Global_Sustainability"},
            {"id": "p2", "project_name": "Nespresso", "project_unique_id": "elsewhere"},
            {"id": "p3", "project_name": "nestle", "project_unique_id": "coffee_global_sustainability"},
        ],
        wetmill_visits=[{"id": "v", "wetmill_id": "1", "visit_date": dt.date(2024, 1, 1), "is_deleted": False}],
        wv_survey_responses=[
            {"form_visit_id": "v", "survey_type": "cpqi", "completed_date": None},
            {"form_visit_id": "v", "survey_type": "kpis", "completed_date": dt.date(2024, 1, 2)},
        ],
    )
    rows = P.enrich_wetmills(t, t["wetmills"]).collect()
    assert sorted((r.id, r.staff_role_id) for r in rows) == [
        ("1", "r1"), ("2", "r1"), ("7", "r1"), ("7", "r3"),
    ]
    assert {r.project_unique_id for r in rows} == {"coffee_global_sustainability"}
    one = next(r for r in rows if r.id == "1")
    assert (one.cpqi_completed, one.cpqi_date) == (False, None)
    assert (one.kpis_completed, one.kpis_date) == (True, dt.date(2024, 1, 2))
    assert programme_projects(t["wetmills"], t["project_staff_roles"], t["projects"], "ELSEWHERE").count() == 5


def test_participants_break_ties_by_id(table):
    rows = table("farmers", *[member(i, "h", f"n{i}") for i in ("c", "b", "a")])
    assert participants(rows).first().household_participants == "na & nb"

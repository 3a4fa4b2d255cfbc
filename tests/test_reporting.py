"""Counts of waiting records and row filters with unknown values."""

from pyspark.sql import functions as F

from sluiceway.functions.predicates import eligible, eligible_one, not_deleted, pending
from sluiceway.operators.joins import exclude_in_flight, lookup, where_ids
from sluiceway.operators.reporting import count_all, count_pending, group_sizes, run_report, run_totals
from tests.conftest import flagged


def outbox(table):
    return table(
        "households",
        {"id": "ready", **flagged()},
        {"id": "unflagged", **flagged(flag=False)},
        {"id": "unknown", **flagged(flag=None)},
        {"id": "failed", **flagged(status="Failed")},
        {"id": "stateless", **flagged(status=None)},
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_pending_ignores_the_flag_and_eligible_does_not(table):
    rows = outbox(table)
    assert ids(eligible(rows)) == ["ready"]
    assert ids(pending(rows)) == ["ready", "unflagged", "unknown"]
    assert ids(eligible_one(rows, "ready")) == ["ready"]
    assert ids(eligible_one(rows, "failed")) == []
    assert count_pending(rows).first().pending == 3


def test_counts_per_entity_include_empty_ones(table):
    counts = count_all({"households": outbox(table), "farmers": table("farmers")})
    assert {r.entity: r.pending for r in counts.collect()} == {"households": 3, "farmers": 0}


def test_unknown_deletion_is_not_live(table):
    rows = table("farmers", *[{"id": str(d), "is_deleted": d} for d in (True, False, None)])
    assert ids(not_deleted(rows)) == ["False"]


def test_semi_and_anti_joins_never_repeat_rows(table):
    rows = outbox(table)
    wanted = table("claims", *[{"entity": "households", "id": i, "open": True} for i in ("ready", "ready", None)])
    assert ids(where_ids(rows, wanted)) == ["ready"]
    assert ids(exclude_in_flight(rows, wanted, "households")) == [
        "failed", "stateless", "unflagged", "unknown",
    ]


def test_null_safe_lookup_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None, "n"), ("a", "x")], "k string, w string")
    plain = {r.v: r.w for r in lookup(left, right, {"k": "k"}, "left").collect()}
    safe = {r.v: r.w for r in lookup(left, right, {"k": "k"}, "left", null_safe=True).collect()}
    assert plain == {1: None, 2: "x", 3: None}
    assert safe == {1: "n", 2: "x", 3: None}


def test_report_counts_the_group_without_a_key(spark):
    members = spark.createDataFrame(
        [("1", "p", "d1"), ("2", "p", "d2"), ("2", "p", "d2"), ("3", None, "d3"), ("4", "q", "d4")],
        "id string, unique_project_key string, payload_id string",
    )
    receipts = spark.createDataFrame(
        [("d2", 500), ("d2", 200), ("d3", 200), ("d4", None)], "payload_id string, status_code int"
    )
    report = run_report(members, receipts, "households")
    assert tuple(report.first()) == ("households", 5, 3, 3)
    assert {r.unique_project_key: r.n_rows for r in group_sizes(members).collect()} == {
        "p": 3, None: 1, "q": 1,
    }
    nothing = run_report(members.filter(F.lit(False)), receipts, "farmers")
    assert tuple(nothing.first()) == ("farmers", 0, 0, 0)
    assert tuple(run_totals(report.unionByName(nothing)).first()) == (5, 3)

"""Whole runs: claim to report, one record, several runs in a row."""

import dataclasses
import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F

from sluiceway.plans.entities import ENTITIES, wetmill_spec
from sluiceway.plans.runs import RecordNotFound, dispatch, finish_run, sync_all, sync_batch, sync_one
from sluiceway.schemas import FLAG, STATUS
from tests.conftest import flagged

DAY = [dt.datetime(2024, 1, d) for d in range(1, 20)]
NOW = {"run_id": "r1", "run_ts": "2024-06-01 00:00:00"}
LIMITS = pytest.mark.parametrize("limit", [-1, None], ids=["small", "backlog"])


def answering(spark, codes):
    """Deliver that answers each group with the codes given for it."""

    def deliver(documents):
        rows = [
            (d.payload_id, code)
            for d in documents.collect()
            for code in codes.get(d.unique_project_key, ())
        ]
        return spark.createDataFrame(rows, "payload_id string, status_code int")

    return deliver


def homes_world(world, homes, members=None, roles=(), **outbox):
    """Households whose group, project and key carry the same name."""
    keys = sorted({k for _, k in homes})
    return world(
        projects=[{"id": k, "project_unique_id": None if k == "none" else k} for k in keys],
        farmer_groups=[{"id": k, "project_id": k, "responsible_staff_id": "s"} for k in keys],
        project_staff_roles=[
            {"id": f"{r}", "project_id": k, "staff_id": "s", "commcare_location_id": r}
            for k in keys for r in roles
        ],
        households=[
            {"id": h, "farmer_group_id": k, **flagged(DAY[i % 19], **outbox)}
            for i, (h, k) in enumerate(homes)
        ],
        farmers=[
            {"id": f"f{h}", "household_id": h, "first_name": h, "is_deleted": False}
            for h in (members if members is not None else [h for h, _ in homes])
        ],
    )


def states(df):
    return {r.id: (r[STATUS], r[FLAG]) for r in df.collect()}


def report(run):
    r = run.report.first()
    return (r.picked, r.sent, r.groups)


@LIMITS
def test_receipts_decide_the_state(spark, world, limit):
    t = homes_world(world, [("a", "p"), ("b", "q"), ("c", "r"), ("d", "none"), ("e", "lost")])
    t["projects"] = t["projects"].filter("id <> 'lost'")
    deliver = answering(spark, {"p": [200], "q": [500], None: [404, 200]})
    run = sync_batch(t, "households", deliver, limit=limit, **NOW)
    assert states(run.new_state(t["households"])) == {
        "a": ("Complete", False),
        "b": ("Failed", True),
        "c": ("Processing", True),
        "d": ("Complete", False),
        "e": ("Processing", True),
    }
    assert report(run) == (4, 2, 4)
    assert [r.id for r in run.dispatch.stranded().collect()] == ["e"]
    new = {r.id: r.updated_at for r in run.new_state(t["households"]).collect()}
    assert set(new.values()) == {dt.datetime(2024, 6, 1)}


@LIMITS
def test_empty_households_are_left_out_but_settled(spark, world, limit):
    t = homes_world(world, [("a", "p"), ("b", "p"), ("c", "q")], members=["a"])
    run = sync_batch(t, "households", answering(spark, {"p": [200], "q": [200]}), limit=limit, **NOW)
    bodies = {d.unique_project_key: json.loads(d.body) for d in run.dispatch.documents.collect()}
    assert [h["householdId"] for h in bodies["p"]["households"]] == ["a"]
    assert bodies["q"]["households"] == []
    assert report(run) == (3, 3, 2)
    assert set(states(run.new_state(t["households"])).values()) == {("Complete", False)}


@LIMITS
def test_document_shape(spark, world, limit):
    t = homes_world(world, [("a", "p")])
    doc = dispatch(t, "households", limit=limit, **NOW).documents.first()
    body = json.loads(doc.body)
    assert list(body) == ["source", "jobType", "uniqueProjectKey", "households", "entity", "id"]
    assert body["id"] == doc.payload_id and body["jobType"] == "Household Sampling"
    assert body["source"] == "postgres" and body["entity"] == "households"
    (home,) = body["households"]
    assert home["fvAAVisited"] == "No" and home["fvAASampled"] == "Yes"
    assert home["moduleName"] is None and home["numberOfMembers"] == 1
    assert home["householdId"] == home["commCareCaseId"] == "a"


@LIMITS
def test_groups_are_cut_without_losing_items(spark, world, limit):
    homes = [(f"h{i}", "p") for i in range(5)]
    t = homes_world(world, homes)
    docs = dispatch(t, "households", limit=limit, max_items=2, **NOW).documents.collect()
    items = {d.chunk: [h["householdId"] for h in json.loads(d.body)["households"]] for d in docs}
    assert items == {0: ["h0", "h1"], 1: ["h2", "h3"], 2: ["h4"]}
    assert len({d.payload_id for d in docs}) == 3
    again = dispatch(t, "households", limit=limit, max_items=2, **NOW).documents.collect()
    assert sorted(docs) == sorted(again)


@LIMITS
def test_record_in_several_documents_needs_all_of_them(spark, world, limit):
    t = homes_world(world, [("a", "p"), ("b", "p")], roles=("w1", "w2", "w3"))
    sent = dispatch(t, "households", limit=limit, max_items=2, **NOW)
    chunks = {d.chunk: d.payload_id for d in sent.documents.collect()}
    assert sorted(chunks) == [0, 1, 2]

    def verdicts(codes):
        rows = [(chunks[c], code) for c, code in codes.items()]
        receipts = spark.createDataFrame(rows, "payload_id string, status_code int")
        run = finish_run(sent, receipts)
        return states(run.new_state(t["households"])), report(run)

    assert verdicts({0: 200, 1: 200, 2: 200}) == (
        {"a": ("Complete", False), "b": ("Complete", False)}, (6, 6, 1),
    )
    assert verdicts({0: 200, 1: 500, 2: 200}) == (
        {"a": ("Failed", True), "b": ("Failed", True)}, (6, 4, 1),
    )
    assert verdicts({0: 200, 1: 200}) == (
        {"a": ("Complete", False), "b": ("Processing", True)}, (6, 4, 1),
    )
    assert verdicts({0: 500, 1: 200, 2: 200})[0] == {"a": ("Failed", True), "b": ("Complete", False)}


def test_duplicate_roles_count_in_report(spark, world):
    t = homes_world(world, [("a", "p")], roles=("w1", "w2"))
    run = sync_batch(t, "households", answering(spark, {"p": [200]}), **NOW)
    assert report(run) == (2, 2, 1)
    (doc,) = run.dispatch.documents.collect()
    assert [h["ccMobileWorkerGroupId"] for h in json.loads(doc.body)["households"]] == ["w1", "w2"]
    assert run.dispatch.claimed.count() == 1


def test_limit_takes_the_oldest(spark, world):
    homes = [(f"h{i}", "p") for i in range(6)]
    t = homes_world(world, homes)
    run = sync_batch(t, "households", answering(spark, {"p": [200]}), limit=2, **NOW)
    done = {i for i, (s, _) in states(run.new_state(t["households"])).items() if s == "Complete"}
    assert done == {"h0", "h1"}


def test_runs_in_a_row_drain_the_backlog_once(spark, world):
    homes = [(f"h{i}", "p") for i in range(5)]
    t = homes_world(world, homes)
    seen = []
    for i in range(4):
        deliver = answering(spark, {"p": [200]})
        run = sync_batch(t, "households", deliver, limit=2, run_id=f"r{i}", run_ts=f"2024-06-0{i + 1}")
        seen.append(sorted(r.id for r in run.dispatch.claimed.collect()))
        t["households"] = run.new_state(t["households"])
    assert seen == [["h0", "h1"], ["h2", "h3"], ["h4"], []]
    assert report(run) == (0, 0, 0)


def test_failed_records_are_not_taken_again(spark, world):
    t = homes_world(world, [("a", "p")])
    run = sync_batch(t, "households", answering(spark, {"p": [500]}), **NOW)
    t["households"] = run.new_state(t["households"])
    again = sync_batch(t, "households", answering(spark, {"p": [200]}), run_id="r2", run_ts="2024-06-02")
    assert report(again) == (0, 0, 0)
    assert states(again.new_state(t["households"])) == {"a": ("Failed", True)}


def roles_world(world):
    return world(
        projects=[{"id": "p", "project_unique_id": "p"}],
        users=[{"id": "u", "first_name": "A", "last_name": "B"}],
        project_staff_roles=[
            {"id": "1", "project_id": "p", "staff_id": "u", "role": "Field Officer", **flagged(DAY[0])},
            {"id": "2", "project_id": "none", "staff_id": "u", **flagged(DAY[0])},
        ],
    )


@LIMITS
def test_staff_roles_go_back_to_pending_and_unmatched_ones_stay(spark, world, limit):
    t = roles_world(world)
    run = sync_batch(t, "project_staff_roles", answering(spark, {"p": [503]}), limit=limit, **NOW)
    assert states(run.new_state(t["project_staff_roles"])) == {
        "1": ("Pending", True), "2": ("Pending", True),
    }
    changes = {(r.id, r.step): r[STATUS] for r in run.changes.collect()}
    assert changes == {("1", 0): "Processing", ("1", 1): "Pending"}
    assert run.dispatch.stranded().count() == 0
    body = json.loads(run.dispatch.documents.first().body)
    assert body["projectRoles"][0]["staffName"] == "A B"
    assert body["projectRoles"][0]["roleForCommCare"] == "Field_Officer"


def test_other_runs_claims_are_left_alone(spark, world, table):
    t = homes_world(world, [("a", "p"), ("b", "p"), ("c", "p"), ("d", "p")])
    claims = table(
        "claims",
        {"entity": "households", "id": "a", "open": True},
        {"entity": "households", "id": "b", "open": False},
        {"entity": "farmers", "id": "c", "open": True},
        {"entity": "households", "id": None, "open": True},
    )
    sent = dispatch(t, "households", claims=claims, **NOW)
    assert {r.id for r in sent.claimed.collect()} == {"b", "c", "d"}
    held = {tuple(r) for r in sent.open_claims().collect()}
    assert ("households", "b", "r1", True) in held and len(held) == 3


def test_one_record(spark, world):
    t = homes_world(world, [("a", "p"), ("b", "p")], roles=("w1", "w2"))
    deliver = answering(spark, {"p": [200]})
    run = sync_one(t, "households", "b", deliver, **NOW)
    assert report(run) == (2, 2, 1)
    assert states(run.new_state(t["households"])) == {"a": ("Pending", True), "b": ("Complete", False)}
    t["households"] = run.new_state(t["households"])
    for missing in ("b", "nobody"):
        with pytest.raises(RecordNotFound):
            sync_one(t, "households", missing, deliver, run_id="r2", run_ts="2024-06-02")
    with pytest.raises(ValueError):
        sync_one(t, "unknown", "b", deliver, **NOW)


def test_one_record_without_its_parents_is_claimed_but_not_found(spark, world):
    t = homes_world(world, [("a", "p")])
    t["projects"] = t["projects"].filter("id <> 'p'")
    with pytest.raises(RecordNotFound) as missing:
        sync_one(t, "households", "a", answering(spark, {}), **NOW)
    assert [(r.id, r[STATUS]) for r in missing.value.dispatch.claim_changes().collect()] == [
        ("a", "Processing")
    ]


def test_one_session_is_sent_once_where_joins_repeat_it(spark, world):
    t = world(
        projects=[{"id": "p", "project_unique_id": "p"}],
        users=[{"id": "s"}],
        training_modules=[{"id": "m", "project_id": "p"}],
        farmer_groups=[{"id": "g", "project_id": "p", "responsible_staff_id": "s"}],
        project_staff_roles=[
            {"id": r, "project_id": "p", "staff_id": "s", "commcare_location_id": r} for r in ("w2", "w1")
        ],
        training_sessions=[{"id": "1", "module_id": "m", "farmer_group_id": "g", **flagged(DAY[0])}],
    )
    deliver = answering(spark, {"p": [200]})
    assert report(sync_one(t, "training_sessions", "1", deliver, **NOW)) == (1, 1, 1)
    assert report(sync_batch(t, "training_sessions", deliver, **NOW)) == (2, 2, 1)


def test_all_entities_run_in_order_with_totals(spark, world):
    t = homes_world(world, [("a", "p"), ("b", "q")])
    roles = roles_world(world)
    t |= {"project_staff_roles": roles["project_staff_roles"], "users": roles["users"]}
    full = sync_all(t, answering(spark, {"p": [200], "q": [500]}), **NOW)
    assert list(full.runs) == list(ENTITIES) == [
        "project_staff_roles", "farmer_groups", "training_sessions", "households", "farmers", "wetmills",
    ]
    assert {r.entity: (r.picked, r.sent, r.groups) for r in full.report.collect()} == {
        "project_staff_roles": (1, 1, 1), "farmer_groups": (0, 0, 0), "training_sessions": (0, 0, 0),
        "households": (2, 1, 2), "farmers": (0, 0, 0), "wetmills": (0, 0, 0),
    }
    assert tuple(full.totals.first()) == (3, 2)


def test_entities_are_claimed_and_packaged_at_the_same_time(spark, world):
    """Each entity waits for the others inside its enrichment: one after another, none would come."""
    t = homes_world(world, [("a", "p"), ("b", "q")])
    together = threading.Barrier(2, timeout=60)

    def waiting(spec):
        def enrich(tables, rows):
            together.wait()
            return spec.enrich(tables, rows)

        return dataclasses.replace(spec, enrich=enrich)

    specs = {name: waiting(ENTITIES[name]) for name in ("households", "farmers")}
    asked = []

    def deliver(documents):
        asked.append(documents.columns)
        return answering(spark, {"p": [200], "q": [500]})(documents)

    full = sync_all(t, deliver, specs, **NOW)
    assert list(full.runs) == ["households", "farmers"] and len(asked) == 2
    assert tuple(full.totals.first()) == (2, 1)


def test_document_ids_are_listed_without_a_join_of_their_items(spark, world):
    t = homes_world(world, [("a", "p"), ("b", "q")])
    sent = dispatch(t, "households", **NOW)
    listed = sent.documents.select("payload_id", "unique_project_key")
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert {tuple(r) for r in listed.collect()} == {(d.payload_id, d.unique_project_key) for d in sent.documents.collect()}


def test_default_limits_and_failure_states():
    assert {n: s.limit for n, s in ENTITIES.items()} == {
        "project_staff_roles": 500, "farmer_groups": 500, "training_sessions": 300,
        "households": 200, "farmers": 500, "wetmills": 500,
    }
    assert {n for n, s in ENTITIES.items() if s.on_fail == "Pending"} == {"project_staff_roles"}


def test_payload_field_names(spark):
    spark.range(1)
    fields = {name: list(spec.fields()) for name, spec in ENTITIES.items()}
    assert {n: len(f) for n, f in fields.items()} == {
        "project_staff_roles": 15, "farmer_groups": 18, "training_sessions": 12,
        "households": 16, "farmers": 26, "wetmills": 36,
    }
    assert wetmill_spec("other").fields().keys() == ENTITIES["wetmills"].fields().keys()


def test_state_invariants_on_a_mixed_backlog(spark, world):
    """Untouched rows stay as they are; claimed ones end in an allowed state; twice is once."""
    homes = [(f"h{i}", f"p{i % 4}") for i in range(40)]
    t = homes_world(world, homes, members=[f"h{i}" for i in range(0, 40, 2)])
    t["households"] = t["households"].withColumn(
        STATUS, F.when(F.col("id") > "h30", "Complete").otherwise(F.col(STATUS))
    )
    deliver = answering(spark, {"p0": [200], "p1": [500], "p2": []})
    run = sync_batch(t, "households", deliver, limit=None, max_items=3, **NOW)
    before, after = states(t["households"]), states(run.new_state(t["households"]))
    claimed = {r.id for r in run.dispatch.claimed.collect()}
    assert before.keys() == after.keys()
    assert all(after[i] == before[i] for i in before.keys() - claimed)
    assert {after[i] for i in claimed} <= {
        ("Complete", False), ("Failed", True), ("Processing", True),
    }
    picked, sent, _ = report(run)
    assert sent <= picked == len(claimed)
    items = sum(d.n_items for d in run.dispatch.documents.collect())
    assert items == len([i for i in claimed if int(i[1:]) % 2 == 0])
    settled_twice = run.new_state(run.new_state(t["households"]))
    assert sorted(settled_twice.collect()) == sorted(run.new_state(t["households"]).collect())


@pytest.mark.parametrize("entity", ["households", "project_staff_roles"])
def test_size_of_claim_does_not_change_what_is_sent(spark, world, monkeypatch, entity):
    """A top-n, a ranked claim and a claim ranked in several ranges agree."""
    homes = [(f"h{i:02}", f"p{i % 3}") for i in range(30)]
    t = homes_world(world, homes, roles=("w1", "w2"))
    t["users"] = world(users=[{"id": "s", "first_name": "S"}])["users"]
    t["project_staff_roles"] = t["project_staff_roles"].withColumns(
        {FLAG: F.lit(True), STATUS: F.lit("Pending")}
    ).withColumn("id", F.concat("project_id", "id"))
    sent = []
    for top_n, rows_per_range in ((100, 100), (0, 100), (0, 2)):
        monkeypatch.setattr("sluiceway.operators.claim.TOP_N", top_n)
        monkeypatch.setattr("sluiceway.operators.positions.ROWS_PER_RANGE", rows_per_range)
        run = dispatch(t, entity, limit=4, **NOW)
        sent.append(sorted((d.payload_id, d.body) for d in run.documents.collect()))
        assert run.claimed.count() == 4
    assert sent[0] == sent[1] == sent[2] and sent[0]


CLAIM_FIRST = ("farmer_groups", "households", "farmers", "wetmills")


def outbox_world(world, n=5):
    """Records of the four entities that are claimed before they are joined."""
    return world(
        projects=[{"id": "p", "project_unique_id": "coffee_global_sustainability", "project_name": "x"}],
        project_staff_roles=[{"id": "r", "project_id": "p", "staff_id": "u"}],
        farmer_groups=[
            {"id": f"g{i}", "project_id": "p", **flagged(DAY[i])} for i in range(n)
        ],
        households=[{"id": f"h{i}", "farmer_group_id": "g0", **flagged(DAY[i])} for i in range(n)],
        farmers=[
            {"id": f"f{i}", "household_id": "h0", "farmer_group_id": "g0", "is_deleted": False, **flagged(DAY[i])}
            for i in range(n)
        ],
        wetmills=[
            {"id": f"w{i}", "user_id": "u", "programme": "x", "is_deleted": False, **flagged(DAY[i])}
            for i in range(n)
        ],
    )


@pytest.mark.parametrize("limit", [None, 3, 200_000])
@pytest.mark.parametrize("entity", CLAIM_FIRST)
def test_a_claim_stays_as_it_was_taken(spark, world, table, tmp_path, entity, limit):
    """Publishing the own claims, or new eligible rows, change nothing of a dispatch."""
    t = outbox_world(world)
    outbox, claims = f"{tmp_path}/outbox", f"{tmp_path}/claims"
    t[entity].filter("id not like '%4'").write.parquet(outbox)
    table("claims", {"entity": entity, "id": "none", "open": True}).write.parquet(claims)
    live = {**t, entity: spark.read.parquet(outbox)}
    sent = dispatch(live, entity, limit=limit, claims=spark.read.parquet(claims), **NOW)
    before = sorted(r.id for r in sent.claimed.collect())
    assert len(before) == (3 if limit == 3 else 4)
    sent.open_claims().write.mode("append").parquet(claims)
    t[entity].filter("id like '%4'").write.mode("append").parquet(outbox)
    for rows in (sent.claimed, sent.claim_changes(), sent.open_claims(), sent.members):
        assert sorted(r.id for r in rows.collect()) == before
    assert sum(d.n_items for d in sent.documents.collect()) <= len(before)
    # Another run finds only what is left; the same run finds its own claims again.
    fresh = {**t, entity: spark.read.parquet(outbox)}
    others = dispatch(fresh, entity, claims=spark.read.parquet(claims), run_id="r2", run_ts="2024-06-02")
    assert {r.id for r in others.claimed.collect()}.isdisjoint(before)
    again = dispatch(fresh, entity, claims=spark.read.parquet(claims), **NOW)
    assert set(before) <= {r.id for r in again.claimed.collect()}


def test_released_runs_leave_nothing(spark, world):
    import os

    from sluiceway.session import release, scratch_folder

    t = homes_world(world, [("a", "p"), ("b", "q")])
    sent = dispatch(t, "households", limit=None, run_id="run/1", run_ts="2024-06-01")
    folder = scratch_folder(spark, "run/1")
    assert sent.documents.count() == 2 and os.listdir(folder)
    assert sent.release() and not os.path.exists(folder)
    assert not sent.release()
    with pytest.raises(ValueError):
        release(spark, "")

"""Physical plans: what reaches the scans, how often tables are exchanged, and
that nothing is broadcast, gathered or paired without a bound."""

import datetime as dt
import re

import pytest

from sluiceway.functions.predicates import eligible
from sluiceway.operators.claim import claim_fifo
from sluiceway.operators.ranking import current_module, module_info, participants
from sluiceway.operators.rollups import child_count, latest_by_type
from sluiceway.plans import enrichment as P
from sluiceway.plans.entities import ENTITIES
from sluiceway.plans.runs import dispatch
from sluiceway.sources.tables import load, load_all
from tests.conftest import flagged


@pytest.fixture(scope="module")
def t(spark, world, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(2024, 1, 1)
    relations = world(
        projects=[{"id": "p", "project_unique_id": "p"}],
        farmer_groups=[
            {"id": "g", "project_id": "p", "focal_farmer_id": "f", "assistant_focal_farmer_id": "f", **flagged(day)}
        ],
        households=[{"id": "h", "farmer_group_id": "g", **flagged(day)}],
        farmers=[{"id": "f", "household_id": "h", "farmer_group_id": "g", "is_deleted": False, **flagged(day)}],
    )
    for name, df in relations.items():
        df.write.parquet(f"{root}/{name}")
    return load_all(spark, root)


@pytest.fixture
def large_tables(spark):
    """Plan as for tables too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def test_eligibility_reaches_the_scan(t):
    text = plan(eligible(t["households"]).select("id"))
    assert "EqualTo(send_to_commcare_status,Pending)" in text
    assert "EqualTo(send_to_commcare,true)" in text
    assert "ReadSchema: struct<id:string,send_to_commcare:boolean,send_to_commcare_status:string>" in text


def test_fifo_claim_is_a_partial_top_n(t):
    text = plan(claim_fifo(t["households"], 200))
    assert "TakeOrderedAndProject(limit=200" in text and "Exchange" not in text


def test_rankings_are_cut_before_the_shuffle(t, large_tables):
    for ranked in (participants(t["farmers"]), current_module(t["training_modules"]), module_info(t["training_modules"])):
        text = plan(ranked)
        exchange = text.index("Exchange hashpartitioning")
        assert "WindowGroupLimit" in text[exchange:], text
        assert re.search(r"WindowGroupLimit \[.*Partial", text[exchange:])
        assert re.search(r"WindowGroupLimit \[.*ASC NULLS LAST\]", text)


def test_participants_shuffle_members_once(t, large_tables):
    assert plan(participants(t["farmers"])).count("Exchange") == 1


def test_counts_are_combined_before_the_shuffle(t, large_tables):
    text = plan(child_count(t["farmer_groups"].select("id"), t["households"], "farmer_group_id", "n"))
    assert text.count("Exchange") == 2 and "partial_count(1)" in text
    assert "ReadSchema: struct<farmer_group_id:string>" in text


def test_survey_dates_scan_each_fact_table_once(t, large_tables):
    text = plan(
        latest_by_type(t["wetmill_visits"], t["wv_survey_responses"], P.RESPONSE_DATED, P.VISIT_DATED)
    )
    assert text.count("FileScan") == 2
    # visits by id, responses by visit, visits by mill
    assert text.count("Exchange") == 3
    assert "In(survey_type" in text


def test_no_enrichment_pairs_everything_or_hints_a_broadcast(t, large_tables):
    for name, spec in ENTITIES.items():
        rows = spec.enrich(t, eligible(t[name]))
        if spec.finish:
            rows = spec.finish(t, rows)
        text = plan(rows)
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "SinglePartition"):
            assert operator not in text, (name, operator)


def test_backlog_side_is_joined_once_to_its_group_dimensions(t, large_tables):
    text = plan(P.enrich_households(t, eligible(t["households"])))
    # Rows once by id for count and names, once by group; and once the ids alone, which the
    # farmers are cut down to. The group keys are few enough here to be planned otherwise.
    assert len(re.findall(r"Exchange hashpartitioning\(id,", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(farmer_group_id,", text)) <= 2


def test_farmers_are_exchanged_once_for_both_leaders(t, large_tables):
    rows = P.enrich_groups(t, eligible(t["farmer_groups"]))
    assert rows.count() == 1  # prunes the roles, so run the full rows as well
    assert len(rows.collect()) == 1
    text = plan(rows)
    assert "ReusedExchange" in text


def test_children_are_cut_down_to_the_claim_whatever_its_size(t, large_tables):
    """The claim's ids share the exchange of the key the child is grouped by next."""
    for claimed in (eligible(t["households"]), claim_fifo(t["households"], 200)):
        text = plan(P.enrich_households(t, claimed))
        assert text.count("LeftSemi") >= 2
        # Counts and names: each exchanges the farmers once, and never again by the same key.
        assert len(re.findall(r"Exchange hashpartitioning\(household_id,", text)) == 2


def test_written_claim_keeps_its_rows_and_cuts_down_children(t, spark):
    sent = dispatch(t, "households", run_id="r", run_ts="2024-06-01", limit=None)
    assert sent.claimed.inputFiles() and "claim-households" in sent.claimed.inputFiles()[0]
    assert not any("/households/" in f for f in sent.claim_changes().inputFiles())


def test_large_limit_becomes_a_predicate_of_the_scan(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr("sluiceway.operators.claim.TOP_N", 0)
    day = [dt.datetime(2024, 1, d) for d in range(1, 9)]
    table("households", *[{"id": str(i), **flagged(day[i])} for i in range(8)]).write.parquet(f"{tmp_path}/households")
    homes = load(spark, str(tmp_path), "households")
    claimed = claim_fifo(homes, 3)
    assert {r.id for r in claimed.collect()} == {"0", "1", "2"}
    assert re.search(r"PushedFilters: .*LessThanOrEqual\(updated_at,2024-01-03", plan(claimed)), plan(claimed)


def test_hot_group_is_split_by_adaptive_execution(spark, world, tmp_path, large_tables):
    """A third of all households in one group: the backlog's join to its group is split."""
    homes = spark.range(60_000).selectExpr(
        "CAST(id AS STRING) AS id",
        "sha2(CAST(id AS STRING), 512) AS household_name",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 500 AS STRING) END AS farmer_group_id",
        "true AS send_to_commcare",
        "'Pending' AS send_to_commcare_status",
        "CAST(NULL AS TIMESTAMP) AS updated_at",
    )
    homes.write.parquet(f"{tmp_path}/households")
    groups = spark.range(501).selectExpr(
        "CASE WHEN id = 500 THEN 'hot' ELSE CAST(id AS STRING) END AS id",
        "CAST(id % 7 AS STRING) AS project_id",
    )
    groups.write.parquet(f"{tmp_path}/farmer_groups")
    t = world(projects=[{"id": str(i), "project_unique_id": f"k{i}"} for i in range(7)])
    for name in ("households", "farmer_groups"):
        t[name] = load(spark, str(tmp_path), name)
    settings = {
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = P.enrich_households(t, eligible(t["households"]))
        kept = rows.select("id", "household_name", "project_unique_id")
        assert len(kept.collect()) == 60_000
        assert "skew=true" in plan(kept)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "3")

import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.claim import (
    claim_fifo,
    claim_grouped,
    take_first,
    take_oldest,
)
from sluiceway.operators.positions import numbered_ranges, with_positions
from tests.conftest import flagged


def hot_rows(n=3000):
    """A third of the rows share one key, another third has no key; many ties."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(40)}"
        rows.append((key, rng.choice([None, 1, 2, 3]), i))
    rng.shuffle(rows)
    return rows


def brute_positions(rows):
    groups = {}
    for key, age, i in rows:
        groups.setdefault(key, []).append((age is None, age or 0, i))
    return {
        i: pos for members in groups.values() for pos, (_, _, i) in enumerate(sorted(members), 1)
    }


def order():
    return [F.col("age").asc_nulls_last(), F.col("i").asc_nulls_last()]


def test_positions_agree_with_brute_force_in_one_range_or_many(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "key string, age int, i int").repartition(7)
    want = brute_positions(rows)
    for rows_per_range in (10_000, 500):
        placed = with_positions(df, ["key"], order(), rows_per_range=rows_per_range)
        assert sorted(placed.columns) == ["age", "i", "key", "pos"]
        assert {r.i: r.pos for r in placed.collect()} == want


def test_hot_key_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(hot_rows(), "key string, age int, i int").repartition(4)
        ranges = numbered_ranges(df, [F.col("key").asc_nulls_first(), *order()], 4)
        sizes = {r["__part"]: r["count"] for r in ranges.groupBy("__part").count().collect()}
        hot = ranges.filter(F.col("key") == "hot").select("__part").distinct().count()
        assert hot > 1 and max(sizes.values()) < 0.5 * sum(sizes.values())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_positions_number_every_row_once(spark):
    rows = hot_rows(500)
    df = spark.createDataFrame(rows, "key string, age int, i int")
    got = with_positions(df, [], order(), rows_per_range=100).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    assert [r.i for r in sorted(got, key=lambda r: r.pos)] == [r[2] for r in want]
    assert sorted(r.pos for r in got) == list(range(1, 501))


def test_empty_input_has_no_positions(spark):
    df = spark.createDataFrame([], "key string, age int, i int")
    assert with_positions(df, ["key"], order(), rows_per_range=1).count() == 0


@pytest.mark.parametrize("limit", [1, 123, 360, 399, 400, 900])
def test_large_limit_takes_the_same_rows_as_a_small_one(spark, monkeypatch, limit):
    df = spark.createDataFrame(
        [(None if i % 9 == 0 else 50 - i % 50, str(i)) for i in range(400)],
        "updated_at int, id string",
    )
    order = ["updated_at", "id"]
    want = {r.id for r in take_first(df, order, limit).collect()}
    assert len(want) == min(limit, 400)
    monkeypatch.setattr("sluiceway.operators.claim.TOP_N", 0)
    timed = df.withColumn("updated_at", F.timestamp_seconds(F.col("updated_at") * 600))
    for large in (take_first(df, order, limit), take_oldest(timed, limit)):
        assert sorted(r.id for r in large.collect()) == sorted(want)


def test_fifo_takes_oldest_first_and_unknown_last(table):
    import datetime as dt

    day = [dt.datetime(2024, 1, d) for d in range(1, 4)]
    rows = table(
        "households",
        {"id": "b", **flagged(day[1])},
        {"id": "a", **flagged(day[1])},
        {"id": "c", **flagged(day[0])},
        {"id": "z", **flagged(None)},
        {"id": "no", **flagged(day[0], flag=False)},
        {"id": "unknown", **flagged(day[0], flag=None)},
        {"id": "failed", **flagged(day[0], status="Failed")},
    )
    assert {r.id for r in claim_fifo(rows, 2).collect()} == {"c", "a"}
    assert {r.id for r in claim_fifo(rows, 3).collect()} == {"c", "a", "b"}
    assert {r.id for r in claim_fifo(rows).collect()} == {"a", "b", "c", "z"}


def test_grouped_claim_counts_joined_rows(spark):
    rows = [("p2", 1, "a"), ("p1", 5, "b"), ("p1", 5, "b"), ("p1", 9, "c"), (None, 0, "d")]
    df = spark.createDataFrame(rows, "project_unique_id string, updated_at int, id string")
    assert sorted(r.id for r in claim_grouped(df, 2).collect()) == ["b", "b"]
    assert sorted(r.id for r in claim_grouped(df, 4).collect()) == ["a", "b", "b", "c"]


@pytest.mark.parametrize("limit", [1_999, 2_000, 2_001, 2_002, 2_500, 3_001, 5_999, 6_000, 6_001])
def test_limit_is_exact_with_repeated_rows(spark, limit):
    """6,000 joined rows, three equal ones per id: exactly ``limit`` are taken, the first by order."""
    rows = [(i // 3 % 500, f"{i // 3:05d}", "x" if i % 3 else None) for i in range(6_000)]
    df = spark.createDataFrame(rows, "updated_at int, id string, note string")
    taken = take_first(df, ["updated_at", "id"], limit).collect()
    assert len(taken) == min(limit, 6_000)
    ranked = sorted(rows, key=lambda r: (r[0], r[1]))
    want = {(r[0], r[1]) for r in ranked[: min(limit, 6_000)]}
    assert {(r.updated_at, r.id) for r in taken} == want
    edge = ranked[min(limit, 6_000) - 1][:2]
    assert sum((r.updated_at, r.id) == edge for r in taken) == sum(r[:2] == edge for r in ranked[:limit])


def test_limit_is_exact_when_one_tie_holds_a_third(spark, monkeypatch):
    monkeypatch.setattr("sluiceway.operators.positions.ROWS_PER_RANGE", 500)
    rows = [(1 if i % 3 == 0 else 2 + i, str(i % 3 == 0 and "same" or i)) for i in range(6_000)]
    df = spark.createDataFrame(rows, "updated_at int, id string")
    for limit in (2_001, 2_500, 4_000):
        taken = take_first(df, ["updated_at", "id"], limit).collect()
        assert len(taken) == limit
        assert sum(r.id == "same" for r in taken) == 2_000


@pytest.mark.parametrize("limit", [10, 1_500, 2_500])
def test_claim_joined_enriches_only_the_winners(spark, limit):
    """The same rows as a claim after all joins, with the dimensions joined to the winners only."""
    from sluiceway.operators.claim import claim_grouped, claim_joined

    records = [(f"r{i:05d}", i % 50, i % 7) for i in range(3_000)] + [(None, 3, 1)]
    candidates = spark.createDataFrame(records, "id string, updated_at int, g int")
    # groups 0, 3 and 6 have no dimension row; others repeat a record once or twice
    dim = spark.createDataFrame(
        [(g, f"p{g % 3}", w) for g in range(7) for w in range(g % 3)] + [(4, "p1", 1)],
        "g int, project_unique_id string, worker_group int",
    )
    seen = []

    def enrich(rows):
        seen.append(rows)
        return rows.join(dim, "g").withColumn("payload", F.concat_ws("-", "id", "worker_group"))

    def rows(df):
        return sorted(map(tuple, df.select("project_unique_id", "updated_at", "id", "worker_group", "payload").collect()), key=repr)

    got = rows(claim_joined(enrich, candidates, limit, ties=("worker_group",)))
    winners = seen[1].count()
    want = rows(claim_grouped(enrich(candidates), limit, ties=("worker_group",)))
    assert got == want and len(got) == limit
    assert winners <= limit

"""Folded rows: any value comes back as it was, and the farmers' wide rows travel folded."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from sluiceway.operators.folding import ESCAPE, NULL, SEPARATOR, fold, foldable, unfold
from sluiceway.plans import enrichment as P

ODD = [
    None, "", " ", "x", "n", "\\", '"', "a\r\nb\x00\t", "ä€𝄞́", "[null]",
    SEPARATOR, SEPARATOR * 3, ESCAPE, ESCAPE * 2, NULL, *(ESCAPE + c for c in "esb"),
    ESCAPE + SEPARATOR, SEPARATOR + ESCAPE, ESCAPE + "e" + "s", ESCAPE + "bFF", ESCAPE + "b" + SEPARATOR,
]


def test_any_values_come_back_as_they_were(spark):
    rows = [
        (k, a, b, n, f, dt.date(2024, 1, 1 + k % 28), None)
        for k, (a, b) in enumerate((a, b) for a in ODD for b in ODD)
        for n, f in ((None, None), (-(2**31), True), (0, False))[k % 3:][:1]
    ]
    df = spark.createDataFrame(rows, "k long, a string, b string, n int, f boolean, d date, z string")
    first = foldable(df, keep=("b", "z"))
    folded = fold(df, "folded", first)
    assert folded.columns == ["k", "b", "d", "z", "folded"]
    rest = foldable(folded)
    again = fold(folded, "folded", rest)
    assert again.columns == ["k", "d", "folded"]
    back = unfold(again, "folded", first + rest).select(*df.columns)
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_bytes_that_are_no_text_come_back(spark):
    df = spark.sql("SELECT k, cast(unhex(h) AS string) AS a, 'x' AS b FROM VALUES (1, 'FF1F1B'), (2, 'C3'), (3, '41') AS t(k, h)")
    fields = foldable(df, keep=("k",))
    back = unfold(fold(df, "folded", fields), "folded", fields)
    got = back.select("k", F.hex(F.col("a").cast("binary")).alias("h"), "b").collect()
    assert sorted(map(tuple, got)) == [(1, "FF1F1B", "x"), (2, "C3", "x"), (3, "41", "x")]


def backlog(world):
    odd = {"first_name": SEPARATOR, "middle_name": "", "last_name": NULL, "gender": ESCAPE, "phone_number": "n"}
    return world(
        projects=[{"id": "p", "project_unique_id": "P"}],
        locations=[{"id": "l", "location_name": "Place"}],
        project_staff_roles=[
            {"id": r, "project_id": "p", "staff_id": "s", "commcare_location_id": f"w{r}"} for r in "12"
        ],
        farmer_groups=[
            {"id": "g", "project_id": "p", "location_id": "l", "responsible_staff_id": "s", "ffg_name": "G"}
        ],
        households=[
            {"id": "h", "household_name": SEPARATOR, "household_number": 7, "farm_size": Decimal(2), "tns_id": ""},
            {"id": "h", "household_name": None, "household_number": None},
        ],
        farmers=[
            {"id": "1", "household_id": "h", "farmer_group_id": "g", "age": 40, "is_primary_household_member": True, **odd},
            {"id": "1", "household_id": "h", "farmer_group_id": "g"},
            {"id": None, "household_id": "h", "farmer_group_id": "g"},
            {"id": "2", "household_id": "", "farmer_group_id": "g"},
            {"id": "3", "household_id": "h", "farmer_group_id": None},
        ],
    )


def test_farmers_keep_odd_values_and_repeated_keys(world):
    t = backlog(world)
    rows = P.enrich_farmers(t, t["farmers"])
    assert rows.columns == [
        "id", "sf_id", "first_name", "middle_name", "last_name", "age", "gender", "phone_number", "other_id",
        "is_primary_household_member", "status", "tns_id", "commcare_case_id", "household_id", "farmer_group_id",
        "updated_at", "household_sf_id", "household_name", "household_number", "household_tns_id",
        "household_farm_size", "group_id", "group_sf_id", "group_name", "group_case_id", "project_id", "location_id",
        "responsible_staff_id", "project_unique_id", "location_name", "worker_group",
    ]
    odd = ("1", SEPARATOR, "", NULL, 40, ESCAPE, "n", True)
    plain = ("1", *[None] * 7)
    nameless = (None, *[None] * 7)
    homes = ((SEPARATOR, 7, "", "2.00"), (None, None, None, None))
    names = (
        "id", "first_name", "middle_name", "last_name", "age", "gender", "phone_number", "is_primary_household_member",
        "household_name", "household_number", "household_tns_id", "household_farm_size", "worker_group",
        "household_id", "group_id", "farmer_group_id", "location_name",
    )
    got = [tuple(r) for r in rows.select(*names).collect()]
    expected = [
        (*farmer, *home, w, "h", "g", "g", "Place")
        for farmer in (odd, plain, nameless) for home in homes for w in ("w1", "w2")
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_exchanges_of_a_backlog_carry_farmers_folded(spark, world, tmp_path):
    t = backlog(world)
    for name in ("farmers", "households", "farmer_groups"):
        t[name].write.parquet(f"{tmp_path}/{name}")
        t[name] = spark.read.schema(t[name].schema).parquet(f"{tmp_path}/{name}")
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in thresholds:
        spark.conf.set(name, "-1")
    try:
        rows = P.enrich_farmers(t, t["farmers"])
        text = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    finally:
        for name in thresholds:
            spark.conf.unset(name)
    carried = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*)\]$", text, re.M)]
    wide = [x.split(", ") for x in carried if "updated_at" in x]
    assert sorted(map(sorted, wide)) == [
        ["farmer_group_id", "folded", "household_id", "updated_at"],
        ["farmer_group_id", "folded", "updated_at"],
    ]

"""The twelve relations as projections of the star schema's tables.

``oracle.py`` states the same projections in SQL. Attributes the tables lack
(missing ids, unknown flags, empty names) are derived from their columns, so
that null and empty cases occur throughout. Every fan-out stays bounded as the
tables grow.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.joins import pick
from sluiceway.plans.enrichment import RESPONSE_DATED, VISIT_DATED
from sluiceway.schemas import FLAG, STATUS, UPDATED

SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
OTHER_SURVEY = "other"
SURVEYS = (*RESPONSE_DATED, *VISIT_DATED, OTHER_SURVEY)
ROLES = ("Farmer Trainer", "Field Officer")
# Customers come fifteen to a supplier, at every scale.
CUSTOMERS_PER_STAFF = 15
WETMILL_KEY = "asia"

# Schemas of the tables, so that reading one needs no look at its files first.
STAR_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

RELATION_NAMES = (
    "projects",
    "users",
    "project_staff_roles",
    "training_modules",
    "farmer_groups",
    "locations",
    "households",
    "farmers",
    "training_sessions",
    "wetmills",
    "wetmill_visits",
    "wv_survey_responses",
)


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _nth(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index + 1).cast("int"))


def _case(subject: str, pairs: dict[str, object], otherwise: object) -> Column:
    result = None
    for value, outcome in pairs.items():
        hit = F.col(subject) == value
        result = F.when(hit, outcome) if result is None else result.when(hit, outcome)
    return result.otherwise(otherwise)


def _sf_id(prefix: str, key: str, subject: str, null: str, empty: str) -> Column:
    """A foreign id that is missing for one value of ``subject``, empty for another."""
    return _case(
        subject, {null: F.lit(None), empty: F.lit("")}, F.concat(F.lit(prefix), _text(key))
    )


def projects(t: Mapping[str, DataFrame]) -> DataFrame:
    joined = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    segment = _nth(SEGMENTS, F.floor(F.col("n_nationkey") / 5) % 5)
    # One key shared by several projects, and one project without a key.
    key = F.when(F.col("r_name") == "ASIA", F.col("r_name")).when(
        F.col("n_name") != "NATION_24", F.col("n_name")
    )
    return pick(
        joined,
        id=_text("n_nationkey"),
        sf_id=_sf_id("PR", "n_nationkey", "r_name", "AFRICA", "AMERICA"),
        project_name=F.concat("n_name", F.lit("_"), segment),
        project_unique_id=key,
    )


def users(t: Mapping[str, DataFrame]) -> DataFrame:
    return pick(
        t["supplier"],
        id=_text("s_suppkey"),
        sf_id=F.when(F.col("s_acctbal") > 0, F.concat(F.lit("U"), _text("s_suppkey"))),
        first_name="s_name",
        middle_name=F.when(F.col("s_nationkey") < 8, "").when(F.col("s_nationkey") < 16, "M"),
        last_name=F.concat(F.lit("N"), _text("s_nationkey")),
        status=F.when(F.col("s_acctbal") > 1000, "Active"),
    )


def _staff_id() -> Column:
    return _text(F.floor(F.col("c_custkey") / CUSTOMERS_PER_STAFF))


def project_staff_roles(t: Mapping[str, DataFrame]) -> DataFrame:
    return pick(
        t["customer"],
        id=_text("c_custkey"),
        sf_id=_sf_id("R", "c_custkey", "c_mktsegment", "BUILDING", "MACHINERY"),
        project_id=_text("c_nationkey"),
        # A fifth of the roles has nobody in it.
        staff_id=F.when(F.col("c_mktsegment") != "FURNITURE", _staff_id()),
        tns_id="c_name",
        role=_nth(ROLES, F.col("c_nationkey") % 2),
        commcare_location_id=F.when(
            F.col("c_acctbal") > 0, F.concat(F.lit("W"), _text("c_custkey"))
        ),
        commcare_case_id=F.when(F.col("c_nationkey") != 3, F.concat(F.lit("RC"), _text("c_custkey"))),
        **{
            FLAG: F.col("c_acctbal") > -500,
            STATUS: _case(
                "c_mktsegment", {"HOUSEHOLD": "Complete", "BUILDING": "Failed"}, "Pending"
            ),
            UPDATED: _customer_time(),
        },
    )


def _customer_time() -> Column:
    """A date that many customers share, unknown for some nations."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey") * 7 % 30)
    return F.when(F.col("c_nationkey") != 11, day.cast("timestamp_ntz"))


def training_modules(t: Mapping[str, DataFrame]) -> DataFrame:
    size = F.col("p_size")
    day = F.date_add(F.lit("2020-01-01").cast("date"), size)
    return pick(
        t["part"],
        id=_text("p_partkey"),
        project_id=_text(F.col("p_partkey") % 25),
        module_name=F.concat("p_name", F.lit(" "), _text("p_partkey")),
        module_number=F.when(size != 20, size),
        current_previous=_nth(("Current", "Previous", "Future"), F.col("p_partkey") % 3),
        current_module=F.when(size != 15, size > 10),
        is_deleted=F.when(size != 22, size % 7 == 0),
        updated_at=F.when(size != 50, day.cast("timestamp_ntz")),
    )


def farmer_groups(t: Mapping[str, DataFrame], leaders: bool = False) -> DataFrame:
    """Customers as groups; with ``leaders`` each names its first and last farmer.

    Finding leaders is an aggregate over the farmers, so only queries that need
    them ask for it.
    """
    base = t["customer"]
    if leaders:
        ends = (
            farmers(t)
            .groupBy("farmer_group_id")
            .agg(F.min("id").alias("focal"), F.max("id").alias("assistant"))
        )
        base = base.join(ends, _text("c_custkey") == F.col("farmer_group_id"), "left")
        focal, assistant = F.col("focal"), F.when(F.col("c_nationkey") != 5, F.col("assistant"))
    else:
        focal = assistant = F.lit(None).cast("string")
    return pick(
        base,
        id=_text("c_custkey"),
        sf_id=_sf_id("G", "c_custkey", "c_mktsegment", "MACHINERY", "BUILDING"),
        tns_id="c_name",
        commcare_case_id=F.concat(F.lit("GC"), _text("c_custkey")),
        ffg_name=F.concat(F.lit("Group "), _text("c_custkey")),
        status=F.when(F.col("c_acctbal") > 0, "Active").otherwise("Inactive"),
        project_id=F.when(F.col("c_nationkey") != 6, _text("c_nationkey")),
        location_id=_text(F.col("c_nationkey") % 7),
        responsible_staff_id=F.when(F.col("c_acctbal") > -900, _staff_id()),
        focal_farmer_id=focal,
        assistant_focal_farmer_id=assistant,
        **{
            FLAG: F.when(F.col("c_nationkey") != 8, F.col("c_nationkey") != 9),
            STATUS: _case(
                "c_mktsegment", {"AUTOMOBILE": "Complete", "FURNITURE": "Processing"}, "Pending"
            ),
            UPDATED: _customer_time(),
        },
    )


def locations(t: Mapping[str, DataFrame]) -> DataFrame:
    return pick(
        t["region"],
        id=_text("r_regionkey"),
        sf_id=F.when(F.col("r_name") != "ASIA", F.concat(F.lit("L"), _text("r_regionkey"))),
        location_name="r_name",
    )


def households(t: Mapping[str, DataFrame]) -> DataFrame:
    key = F.col("o_orderkey")
    return pick(
        t["orders"],
        id=_text("o_orderkey"),
        sf_id=_sf_id("H", "o_orderkey", "o_orderpriority", "1-URGENT", "2-HIGH"),
        household_name=F.concat(F.lit("Home "), _text("o_orderkey")),
        household_number=(key % 1000).cast("int"),
        tns_id=F.concat(F.lit("T"), _text("o_orderkey")),
        commcare_case_id=F.concat(F.lit("HC"), _text("o_orderkey")),
        status=_case("o_orderpriority", {"3-MEDIUM": F.lit(None)}, "Active"),
        visited_for_fv_aa=F.when(F.col("o_orderpriority") != "2-HIGH", key % 2 == 0),
        sampled_for_fv_aa=F.lit(True),
        fv_aa_sampling_round=F.when(key % 4 != 0, (key % 4).cast("int")),
        farm_size=F.when(key % 9 != 0, (key % 700).cast("decimal(10,2)")),
        farmer_group_id=F.when(key % 97 != 0, _text("o_custkey")),
        **{
            # False for low, unknown for unspecified; the first part can be pushed down.
            FLAG: (F.col("o_orderpriority") != "5-LOW")
            & F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", True),
            STATUS: _case("o_orderstatus", {"P": "Pending", "F": "Failed"}, "Complete"),
            UPDATED: F.when(key % 50 != 0, F.col("o_orderdate")),
        },
    )


def farmers(t: Mapping[str, DataFrame]) -> DataFrame:
    line = F.col("l_linenumber")
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    shipped = F.unix_date(F.col("l_shipdate").cast("date"))
    record = F.concat_ws("-", *[_text(c) for c in keys], _text(shipped))
    flagged = F.when(line != 4, F.col("l_linestatus") == "O")
    return pick(
        t["lineitem"],
        id=record,
        sf_id=F.when(line == 1, "").when(line != 2, F.concat(F.lit("F"), record)),
        first_name=F.when(line != 7, F.concat(F.lit("F"), _text("l_partkey"))),
        middle_name=F.when(line < 4, F.concat(F.lit("M"), _text("l_suppkey"))),
        last_name=F.concat(F.lit("L"), _text("l_suppkey")),
        age=F.col("l_quantity").cast("int"),
        gender="l_linestatus",
        phone_number=F.when(line == 3, F.concat(F.lit("07"), _text("l_partkey"))),
        other_id=F.lit(None).cast("string"),
        is_primary_household_member=F.when(line != 5, F.col("l_linestatus") == "O"),
        status=F.when(F.col("l_returnflag") == "R", "Inactive").otherwise("Active"),
        tns_id=F.concat(F.lit("TF"), record),
        commcare_case_id=F.when(line == 6, "").when(line > 1, F.concat(F.lit("FC"), record)),
        household_id=_text("l_orderkey"),
        # Parts outnumber customers, so some farmers have no group.
        farmer_group_id=_text("l_partkey"),
        is_deleted=F.when(F.col("l_returnflag") == "R", True).when(
            (F.col("l_returnflag") != "N") | (line != 6), False
        ),
        **{
            FLAG: flagged,
            STATUS: _case("l_returnflag", {"A": "Pending", "N": "Complete"}, "Failed"),
            UPDATED: F.when(line != 3, F.col("l_shipdate")),
        },
    )


def training_sessions(t: Mapping[str, DataFrame]) -> DataFrame:
    day = F.col("ts").cast("date")
    return pick(
        t["events"],
        id=_text("event_id"),
        sf_id=_sf_id("S", "event_id", "event_type", "click", "signup"),
        commcare_case_id=F.concat(F.lit("SC"), _text("event_id")),
        module_id=F.when(F.col("event_type") != "error", _text(F.col("event_id") % 200)),
        farmer_group_id=_text("user_id"),
        date_session_1=day,
        date_session_2=F.when(F.col("event_id") % 3 != 0, F.date_add(day, 7)),
        **{
            FLAG: F.when(F.col("user_id") % 20 != 7, F.col("user_id") % 20 != 9),
            STATUS: _case(
                "event_type", {"purchase": "Complete", "view": "Processing"}, "Pending"
            ),
            UPDATED: F.col("ts"),
        },
    )


def wetmills(t: Mapping[str, DataFrame]) -> DataFrame:
    nation = F.col("c_nationkey")
    # One programme is a LIKE pattern, one is unknown.
    programme = F.when(F.col("c_mktsegment") == "FURNITURE", "FURNI_URE").when(
        nation != 4, F.col("c_mktsegment")
    )
    return pick(
        t["customer"],
        id=_text("c_custkey"),
        user_id=_staff_id(),
        wet_mill_unique_id=F.concat(F.lit("WM"), _text("c_custkey")),
        commcare_case_id=F.when(nation != 2, F.concat(F.lit("WC"), _text("c_custkey"))),
        name="c_name",
        mill_status=_nth(("Cooperative", "Private"), nation % 2),
        exporting_status=F.when(nation % 3 == 0, "Exporting"),
        programme=programme,
        country=F.concat(F.lit("Country "), _text("c_nationkey")),
        manager_name=F.concat(F.lit("Manager "), _text("c_custkey")),
        manager_role=F.lit("Manager"),
        comments=F.lit(None).cast("string"),
        status=F.lit("Active"),
        mill_external_id=_sf_id("X", "c_custkey", "c_mktsegment", "BUILDING", "MACHINERY"),
        registration_date=F.when(
            nation != 1, F.date_add(F.lit("2021-01-01").cast("date"), nation)
        ),
        is_deleted=F.when(nation != 13, nation == 14),
        **{
            FLAG: F.col("c_acctbal") > 0,
            STATUS: _case("c_mktsegment", {"HOUSEHOLD": "Failed"}, "Pending"),
            UPDATED: _customer_time(),
        },
    )


def wetmill_visits(t: Mapping[str, DataFrame]) -> DataFrame:
    return pick(
        t["orders"],
        id=_text("o_orderkey"),
        wetmill_id=_text("o_custkey"),
        visit_date=F.col("o_orderdate").cast("date"),
        is_deleted=F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderstatus") == "F"
        ),
    )


def wv_survey_responses(t: Mapping[str, DataFrame]) -> DataFrame:
    return pick(
        t["lineitem"],
        form_visit_id=_text("l_orderkey"),
        survey_type=_nth(SURVEYS, F.col("l_partkey") % len(SURVEYS)),
        completed_date=F.when(F.col("l_linenumber") != 7, F.col("l_shipdate").cast("date")),
    )


def claims(t: Mapping[str, DataFrame]) -> DataFrame:
    """Claims that another run made on all orders; those of urgent ones are open."""
    return pick(
        t["orders"],
        entity=F.lit("households"),
        id=_text("o_orderkey"),
        run_id=F.lit("other"),
        open=F.col("o_orderpriority") == "1-URGENT",
    )


class StarTables(dict):
    """The star schema's own tables, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark = spark
        self.root = root

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.spark.read.schema(STAR_TABLES[name]).parquet(
            f"{self.root}/{name}.parquet"
        )
        return self[name]


class StarSchema(Mapping):
    """The relations over one folder of star-schema parquet files."""

    def __init__(self, spark: SparkSession, root: str, leaders: bool = False):
        self.spark = spark
        self.root = root
        self.leaders = leaders
        self.base = StarTables(spark, root)
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RELATION_NAMES:
            raise KeyError(name)
        if name not in self._views:
            if name == "farmer_groups":
                self._views[name] = farmer_groups(self.base, self.leaders)
            else:
                self._views[name] = globals()[name](self.base)
        return self._views[name]

    def __iter__(self):
        return iter(RELATION_NAMES)

    def __len__(self) -> int:
        return len(RELATION_NAMES)

    def claims(self) -> DataFrame:
        return claims(self.base)

    def receipts(self, documents: DataFrame) -> DataFrame:
        """Receipts for documents, by the region of the project they are for.

        Europe refuses, the Middle East does not answer, the rest accepts.
        """
        where = self.base["nation"].join(
            self.base["region"], F.col("n_regionkey") == F.col("r_regionkey")
        )
        code = F.when(F.col("r_name") == "EUROPE", 500).otherwise(200)
        codes = where.filter(F.col("r_name") != "MIDDLE EAST").select(
            F.when(F.col("r_name") == "ASIA", F.col("r_name"))
            .otherwise(F.col("n_name"))
            .alias("group_key"),
            code.alias("status_code"),
        ).distinct()
        # The wetmill key is in lower case.
        key = F.when(F.col("unique_project_key") == WETMILL_KEY, F.upper("unique_project_key"))
        asked = documents.select(
            "payload_id", F.coalesce(key, "unique_project_key").alias("asked_key")
        )
        return asked.join(codes, F.col("asked_key") == F.col("group_key")).select(
            "payload_id", "status_code"
        )


@lru_cache(maxsize=16)
def star_schema(spark: SparkSession, root: str, leaders: bool = False) -> StarSchema:
    """The relations over ``root``, whose definitions later queries reuse."""
    return StarSchema(spark, root, leaders)

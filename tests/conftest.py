from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluiceway.schemas import CHANGES, CLAIMS, RECEIPTS, RELATIONS  # noqa: E402

SCHEMAS = RELATIONS | {"receipts": RECEIPTS, "claims": CLAIMS, "changes": CHANGES}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Make a relation from dicts; columns a row leaves out are null."""

    empty = {name: spark.createDataFrame([], ddl) for name, ddl in SCHEMAS.items()}

    def make(name: str, *rows: dict):
        if not rows:
            return empty[name]
        columns = empty[name].columns
        for row in rows:
            assert set(row) <= set(columns), set(row) - set(columns)
        data = [tuple(row.get(c) for c in columns) for row in rows]
        return spark.createDataFrame(data, empty[name].schema)

    return make


@pytest.fixture(scope="session")
def world(table):
    """All twelve relations, empty unless given as lists of dicts."""

    def make(**rows: list[dict]):
        return {name: table(name, *rows.get(name, ())) for name in RELATIONS}

    return make


def flagged(when=None, status="Pending", flag=True) -> dict:
    """Outbox columns of a record."""
    return {"send_to_commcare": flag, "send_to_commcare_status": status, "updated_at": when}

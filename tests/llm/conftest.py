from __future__ import annotations

import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="session")
def clashing(spark):
    """A table with columns whose names the operators use inside."""

    def make(df):
        from pyspark.sql import functions as F

        names = (
            "size taken target mark slice part pattern rest end more fp key mask root node score predicted spans found"
            " start length rank number vector class rep weight list block n layout place segment sketch toxic row"
        ).split()
        return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])

    return make


assert Row

"""Scalar expressions: native columns only, so they stay in generated code.

Text rules follow the payload contract, in which an empty string counts as
missing and booleans have three different spellings.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: ColumnOrName) -> Column:
    return F.nullif(_col(c), F.lit(""))


def prefer_id(first: ColumnOrName, second: ColumnOrName) -> Column:
    """``first`` unless it is null or empty, otherwise ``second`` as it is."""
    return F.coalesce(empty_to_null(first), _col(second))


def full_name(*parts: ColumnOrName) -> Column:
    """Non-empty parts joined by one space; an empty string when none is left."""
    return F.concat_ws(" ", *[empty_to_null(p) for p in parts])


def join_names(n: ColumnOrName, first: ColumnOrName, second: ColumnOrName) -> Column:
    """``first`` for one name, ``first & second`` for two (null if either is)."""
    n = _col(n)
    return F.when(n == 1, _col(first)).when(
        n == 2, F.concat(_col(first), F.lit(" & "), _col(second))
    )


def underscore(c: ColumnOrName) -> Column:
    return F.replace(_col(c), F.lit(" "), F.lit("_"))


def yes_no(b: ColumnOrName) -> Column:
    return F.when(_col(b), "Yes").otherwise("No")


def true_false(b: ColumnOrName) -> Column:
    return F.when(_col(b), "TRUE").otherwise("FALSE")


def py_bool(b: ColumnOrName) -> Column:
    """``True`` / ``False``, null kept."""
    b = _col(b)
    return F.when(b, "True").when(~b, "False")


def iso_date(d: ColumnOrName) -> Column:
    return _col(d).cast("date").cast("string")


def cast_all(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(t) for name, t in types.items()})


def const(value: object, dtype: str = "string") -> Column:
    return F.lit(value).cast(dtype)


def run_time(run_ts: datetime | date | str, dtype: DataType | str = "timestamp") -> Column:
    """The run's timestamp as a literal of the state column's own type.

    It goes through its text form, so that a timestamp without time zone is not
    shifted by the session's zone.
    """
    text = run_ts if isinstance(run_ts, str) else run_ts.isoformat(sep=" ")
    return F.lit(text).cast(dtype)


def to_json_keep_nulls(struct: ColumnOrName) -> Column:
    return F.to_json(_col(struct), {"ignoreNullFields": "false"})


def doc_id(
    entity: ColumnOrName, run_id: ColumnOrName, key: ColumnOrName, chunk: ColumnOrName
) -> Column:
    """Document id that a repeated run computes again, for receivers to de-duplicate.

    The JSON form keeps a null key apart from an empty one and needs no separator.
    """
    parts = F.struct(
        _col(entity).alias("entity"),
        _col(run_id).alias("run"),
        _col(key).alias("key"),
        _col(chunk).alias("chunk"),
    )
    return F.sha2(to_json_keep_nulls(parts), 256)

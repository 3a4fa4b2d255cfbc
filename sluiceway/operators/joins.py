"""Joins. None carries a broadcast hint: Spark broadcasts a side when its size,
known from file statistics or measured by adaptive execution, is under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges with
adaptive splitting of skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.predicates import contains_ignore_case, equals_ignore_case


def pick(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Project to ``new_name="old_name"`` (or an expression)."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Attach ``dim``'s columns where ``df[left] = dim[right]`` for each pair in ``on``.

    The right-hand key columns are not kept. Rows multiply when ``dim`` repeats
    a key. With ``null_safe`` a null key matches a null key.
    """
    hidden = {right: f"__{right}" for right in on.values()}
    keyed = dim.withColumnsRenamed(hidden)
    pairs = [(df[left], keyed[hidden[right]]) for left, right in on.items()]
    condition = reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    return df.join(keyed, condition, how).drop(*hidden.values())


def with_staff_role(
    df: DataFrame,
    roles: DataFrame,
    project: str = "project_id",
    staff: str = "responsible_staff_id",
    **columns: str,
) -> DataFrame:
    """Left join to the project-staff bridge; repeated roles repeat the row."""
    bridge = pick(roles, role_project="project_id", role_staff="staff_id", **columns)
    return lookup(df, bridge, {project: "role_project", staff: "role_staff"}, "left")


def with_farmer_role(df: DataFrame, farmers: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left join to the farmer who plays one role, as ``<prefix>_id`` / ``_case_id``.

    Both roles project ``farmers`` to the same columns before the shuffle, so
    Spark exchanges the table once and reuses it for the second role.
    """
    member = pick(farmers, farmer="id", case="commcare_case_id")
    joined = df.join(member, F.col(key) == F.col("farmer"), "left")
    return joined.withColumnsRenamed({"farmer": f"{prefix}_id", "case": f"{prefix}_case_id"})


def where_ids(df: DataFrame, ids: DataFrame, on: str = "id", ids_on: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``on`` is among ``ids``; never repeats a row."""
    return df.join(pick(ids, wanted=ids_on), F.col(on) == F.col("wanted"), "left_semi")


def narrow(df: DataFrame, on: str, rows: DataFrame, rows_on: str) -> DataFrame:
    """Keep what the claimed ``rows`` can reach, before ``df`` is aggregated or joined.

    ``rows`` are written, so their size is known: Spark broadcasts a small claim's keys
    against a large ``df``. A backlog's keys are shuffled, as is ``df``, by the key that
    it is grouped or joined by next, which adds an exchange of the keys alone.
    """
    return where_ids(df, rows, on, rows_on)


def exclude_in_flight(
    df: DataFrame, claims: DataFrame, entity: str, run_id: str | None = None
) -> DataFrame:
    """Drop records that another run than ``run_id`` holds an open claim on."""
    held = claims.filter(F.col("open") & (F.col("entity") == entity))
    if run_id is not None:
        held = held.filter(~F.col("run_id").eqNullSafe(run_id))
    return df.join(pick(held, held_id="id"), F.col("id") == F.col("held_id"), "left_anti")


def stranded(claimed: DataFrame, enriched: DataFrame) -> DataFrame:
    """Claimed records that the inner joins of enrichment lost."""
    return claimed.join(pick(enriched, kept_id="id"), F.col("id") == F.col("kept_id"), "left_anti")


def programme_projects(
    df: DataFrame, roles: DataFrame, projects: DataFrame, group_key: str
) -> DataFrame:
    """Roles of each row's user in the projects under ``group_key`` that carry
    the row's programme in their name.

    Projects are cut down to the one key before they meet the bridge; the LIKE
    is a residual condition of the equi join on the user.
    """
    wanted = pick(
        projects.filter(equals_ignore_case(F.col("project_unique_id"), group_key)),
        pid="id",
        project_name="project_name",
        project_unique_id=F.lower("project_unique_id"),
    )
    bridge = pick(
        roles,
        role_project="project_id",
        role_user="staff_id",
        staff_role_id="id",
        staff_case_id="commcare_case_id",
        worker_group="commcare_location_id",
    )
    holders = lookup(bridge, wanted, {"role_project": "pid"})
    matches = (df["user_id"] == holders["role_user"]) & contains_ignore_case(
        holders["project_name"], df["programme"]
    )
    return df.join(holders, matches).drop("role_user", "role_project")

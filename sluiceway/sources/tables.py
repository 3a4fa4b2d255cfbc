"""Reading relations, receipts and record state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sluiceway.schemas import CHANGES, FLAG, RELATIONS, STATUS, UPDATED


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the twelve relations, from parquet under ``root/name``."""
    return spark.read.schema(RELATIONS[name]).parquet(f"{root}/{name}")


def load_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: load(spark, root, name) for name in RELATIONS}


def read_receipts(df: DataFrame) -> DataFrame:
    """Delivery receipts, checked for the columns and types they need."""
    found = dict(df.dtypes)
    for column in ("payload_id", "status_code"):
        if column not in found:
            raise ValueError(f"receipts lack column {column}")
    if found["payload_id"] != "string":
        raise ValueError("receipts.payload_id must be a string")
    if found["status_code"] not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("receipts.status_code must be an integer")
    return df.select("payload_id", F.col("status_code").cast("int"))


def read_changes(spark: SparkSession, path: str, after: list[Row] | None = None) -> DataFrame:
    """The log of state changes written by :func:`sinks.append_changes`.

    ``after``, a mark from :func:`read_folded`, leaves out the runs that a version of the
    table already holds and that were settled when it was written; their files are not read.
    All else is read, whatever its day or sequence: a run may be settled after later ones were folded.
    """
    log = spark.read.schema(CHANGES).parquet(path)
    for mark in after or []:
        if mark.runs:
            log = log.filter(~((F.col("entity") == mark.entity) & F.col("run_id").isin(mark.runs)))
    return log


def read_folded(spark: SparkSession, path: str, version: str) -> list[Row]:
    """What of the log a written version holds for good: ``entity`` and its settled ``runs``."""
    return spark.read.schema("entity string, runs array<string>").parquet(f"{path}/_folded/{version}").collect()


def read_state(spark: SparkSession, path: str, version: str, name: str) -> DataFrame:
    """One written version of an outbox relation."""
    return spark.read.schema(RELATIONS[name]).parquet(f"{path}/version={version}")


def current_state(
    state: DataFrame, changes: DataFrame, entity: str, own: bool = False
) -> DataFrame:
    """``state`` as the log of changes leaves it.

    The log is reduced to one row per record before it meets the table: the latest
    change, by run and step, and the times of update that changes were made from. It
    applies if one of them is the record's: then the log begins at the record as it is.
    Otherwise the record was edited after the log's changes, or holds them already, and keeps
    its own values, so flagging it again makes it eligible again. Clocks are not compared.
    With ``own`` every change counts, as is right for the very state a run was made from.
    """
    updated_type = state.schema[UPDATED].dataType
    latest = (
        changes.filter(F.col("entity") == entity)
        .groupBy("id")
        .agg(
            F.max_by(F.struct(FLAG, STATUS, UPDATED), F.struct("run_seq", "step")).alias("change"),
            F.collect_set(F.col("seen_at").cast(updated_type)).alias("seen"),
            F.max(F.col("seen_at").isNull()).alias("seen_null"),
        )
        .select(F.col("id").alias("changed_id"), "change", "seen", "seen_null")
    )
    changed_at = F.col(f"change.{UPDATED}").cast(updated_type)
    applied = F.col("changed_id").isNotNull()
    if not own:
        begins = F.when(F.col(UPDATED).isNull(), F.col("seen_null")).otherwise(
            F.array_contains("seen", F.col(UPDATED))
        )
        applied = applied & F.coalesce(begins, F.lit(False))
    joined = state.join(latest, F.col("id") == F.col("changed_id"), "left")
    new = {
        FLAG: F.col(f"change.{FLAG}"),
        STATUS: F.col(f"change.{STATUS}"),
        UPDATED: changed_at,
    }
    return joined.select(
        *[
            F.when(applied, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in state.columns
        ]
    )

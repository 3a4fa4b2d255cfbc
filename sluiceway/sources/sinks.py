"""Writing documents, state changes and record state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.schemas import COMPLETE, FLAG, STATUS, UPDATED


def write_payloads(
    payloads: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "json"
) -> None:
    """Write documents by entity.

    ``json`` writes one document per line exactly as packaged, nulls included;
    ``parquet`` keeps the document's key, chunk and id as columns beside it.
    """
    if fmt == "json":
        lines = payloads.select("entity", F.col("body").alias("value"))
        lines.write.mode(mode).partitionBy("entity").text(path)
    elif fmt == "parquet":
        payloads.write.mode(mode).partitionBy("entity").parquet(path)
    else:
        raise ValueError(f"unsupported payload format: {fmt}")


def append_changes(changes: DataFrame, path: str) -> None:
    """Add state changes to the log at ``path``.

    A run writes as much as it changed, not as much as the table holds, below the
    entity and day, so that readers can leave out what is folded. Writing the same
    run and step again replaces them, so a repeated run is harmless.
    """
    (
        changes.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity", "day", "run_id", "step")
        .parquet(path)
    )


def settled_runs(log: DataFrame) -> DataFrame:
    """``entity`` and ``runs``: the ids of the runs that need not be read again once ``log`` is folded.

    A run is open while a record's last change by it is not Complete and no later run changed that
    record: its settlement may still come, or come again. Runs before the first open one are
    settled; without an open one all but the last are. Order is by sequence, clocks are not compared.
    """
    last = log.groupBy("entity", "run_id", "run_seq", "id").agg(F.max_by(STATUS, "step").alias("last"))
    latest = F.max("run_seq").over(Window.partitionBy("entity", "id"))
    is_open = ~F.col("last").eqNullSafe(F.lit(COMPLETE)) & (F.col("run_seq") >= latest)
    runs = (
        last.withColumn("open", is_open)
        .groupBy("entity", "run_id", "run_seq")
        .agg(F.max(F.coalesce("open", F.lit(True))).alias("open"))
    )
    least = runs.groupBy("entity").agg(
        F.coalesce(F.min(F.when(F.col("open"), F.col("run_seq"))), F.max("run_seq")).alias("least")
    )
    settled = F.when(F.col("run_seq") < F.col("least"), F.col("run_id"))
    return runs.join(least, "entity").groupBy("entity").agg(F.collect_set(settled).alias("runs"))


def write_state(
    state: DataFrame, path: str, version: str, folded: DataFrame | None = None, entity: str | None = None
) -> None:
    """Write a whole new version of a relation, to fold a long log into it.

    A version is never overwritten, so the one being read stays as it is. ``folded``
    is the log that went into it; which of its runs are settled is written beside the version, by
    entity. ``entity`` names the state's own where ``folded`` holds others, too.
    """
    state.write.mode("errorifexists").parquet(f"{path}/version={version}")
    if folded is not None:
        own = folded if entity is None else folded.filter(F.col("entity") == entity)
        settled_runs(own).coalesce(1).write.mode("errorifexists").parquet(f"{path}/_folded/{version}")


def merge_changes(changes: DataFrame, table: str) -> None:
    """Apply settled changes in place where the table's catalog can merge rows.

    ``changes`` holds at most one row per id.
    """
    (
        changes.alias("c")
        .mergeInto(table, F.expr(f"{table}.id = c.id"))
        .whenMatched()
        .update({name: F.col(f"c.{name}") for name in (FLAG, STATUS, UPDATED)})
        .merge()
    )

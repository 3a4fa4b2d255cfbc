"""Shared scratch space for tables a run writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return named


def name_shared_dir(spark: SparkSession) -> None:
    """Name the folder where the session does not, for programs that start their own session.

    A local session's driver and executors share one disk, so a temporary folder will do;
    otherwise it lies in the warehouse, which all executors reach.
    """
    if spark.conf.get(CHECKPOINT_DIR, None):
        return
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        named = tempfile.mkdtemp(prefix="sluiceway-")
    else:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    spark.conf.set(CHECKPOINT_DIR, named)


def scratch_folder(spark: SparkSession, run: str = "") -> str:
    """Folder of what one run, or anything outside a run, writes for itself."""
    return f"{shared_dir(spark).rstrip('/')}/sluiceway/{quote(run, safe='') or '_'}"


def scratch_path(spark: SparkSession, label: str, run: str = "") -> str:
    return f"{scratch_folder(spark, run)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession, run: str) -> bool:
    """Delete what a run wrote for itself, once its results are stored; was there anything?"""
    if not run:
        raise ValueError("name a run")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark, run))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_once(df: DataFrame, label: str, run: str = "") -> DataFrame:
    """Write ``df`` to the shared folder, below its ``run``'s, and return it read back.

    The result no longer depends on the plan that made it, so it survives lost
    executors without recomputing that plan, is the same rows for every reader,
    has exact size statistics, and still allows column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, run)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

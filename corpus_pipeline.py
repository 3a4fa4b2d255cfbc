"""A corpus pipeline: toxicity, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import mixing, packing, pii, simhash, toxicity
from sluiceway.llm.common import table
from sluiceway.session import name_shared_dir, write_once

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids that are broadcast at most, some 50 MB; more are joined by a shuffle.
FEW_IDS = 2_000_000


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, does not call toxic."""
    docs = docs.select(*COLUMNS)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the group's least id.

    Decided row by row. An id held by one row is kept when it is its group's least; such
    rows are left out by an anti join on their ids, so no text is shuffled. Rows that share
    an id may lie in different groups: only they get their fingerprints again, each is kept
    when its own group's least id is its id, and of the kept rows of one id one stays (equal
    ids in one group are copies). Rows without an id have nothing to be told apart by and all
    stay. Very long and empty texts are fingerprinted whole (empty: fingerprint 0).
    """
    docs = docs.select(*COLUMNS)
    found = simhash.near_duplicates(docs, shingle=3, radius=2)
    per_id = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.min("component_id").alias("least")
    )
    leave = write_once(per_id.where("rows > 1 OR doc_id != least").select("doc_id", "rows"), "pipeline-repeats")
    # Ids to leave out: broadcast if they are few, so that no text is shuffled.
    known = F.broadcast(leave) if leave.count() <= FEW_IDS else leave
    kept = docs.join(known.select("doc_id"), "doc_id", "left_anti")
    shared = leave.where("rows > 1").select("doc_id")
    if not shared.isEmpty():
        rows = write_once(
            docs.join(shared, "doc_id", "left_semi").withColumn("row", F.monotonically_increasing_id()), "pipeline-shared"
        )
        own = simhash.fingerprints(rows.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row")
        groups = found.select("fp", "component_id").distinct()
        decided = rows.join(own, "row").join(groups, "fp")
        chosen = decided.where(F.col("doc_id") == F.col("component_id")).dropDuplicates(["doc_id"])
        kept = kept.unionByName(chosen.select(*COLUMNS))
    return kept


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the names of its kinds."""
    return _counted(pii.redacted(docs.select(*COLUMNS)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as the mix of sources takes them, repeated where it does."""
    return mixing.mixed(docs.select(*COLUMNS), F.array(F.col("source"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    name_shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = write_once(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs


#: SQL cannot express the lexicon, the fingerprints' links or the packing; tests/llm checks the rows.
ORACLE_SQL = None

"""Contiguous shards of near equal bytes, by global prefix sums (DataFrame functions only).

Method: every row gets a size (UTF-8 bytes of its text, none for null, plus 1). Rows are put
in one total order -- ``doc_id`` (nulls first), then the text's crc32, then the size -- and cut
into range blocks; each block's byte total is one small row, and a window over those rows
plus one inside each block gives the bytes before every row (``prefix.running``). A row goes
to the shard in which the middle of its bytes falls, among ``shards`` equal parts of the
total. Shards are therefore contiguous runs of the order, and each holds the total over
``shards`` give or take the largest row. ``slot`` numbers a shard's rows from 0 in the order.

Defined results: a null text has size 1 and crc32 0 (that of no bytes); a null ``doc_id``
comes first; repeated rows each get their own slot (equal rows in any order); very long texts
are only measured; an empty table gives no rows; other columns of ``docs`` are not carried,
so names that clash with the output do no harm. The law is always ``bytes``, so
``grown_shard`` is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running

LAW = "bytes"


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", run: str = "") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    placed = running(rows, [], order, {"bytes": F.col("size")}, run=run)
    cut = F.expr(f"((bytes_before * 2 + size) * {shards}) div (bytes_all * 2)")
    with_shard = placed.withColumn("shard", F.least(F.lit(shards - 1), cut).cast("int"))
    # at most ``shards`` rows; a shard's rows are contiguous, so its first place starts its slots
    starts = with_shard.groupBy("shard").agg(F.min("pos").alias("first"))
    return with_shard.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("pos") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


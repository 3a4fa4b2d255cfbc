"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are neither a blank nor \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of every row, and ``more`` columns."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *more,
    )


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the text ``null``."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def lower_ascii(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased; bytes.lower() leaves all else alone."""
    return text.encode("utf-8", "surrogatepass").lower()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that a task's memory is bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def long_array(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))

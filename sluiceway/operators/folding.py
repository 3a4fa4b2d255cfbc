"""Folding: the values of a wide row in one column, for as long as the row is exchanged.

A row of the shuffle spends a word on every column and pads every text to whole words.
Folded values spend a separator each, so wide rows take less disk to shuffle, sort and
spill. Nulls, empty texts and any other content come back as they were, byte for byte.

The column is binary, of which Spark assumes 100 bytes a row and not 20 as of a text: sizes
planned from files stay near the truth, and no more is broadcast by them.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField

# Types whose values have one text each, from which they come back.
FOLDED = (StringType(), IntegerType(), BooleanType())

SEPARATOR = "\x1f"
ESCAPE = "\x1b"
# What the escape stands before: itself, a separator, bytes that are no text (as hex
# digits), and a null alone.
ITSELF, SEPARATED, BYTES, NULL = (ESCAPE + letter for letter in "esbn")


def _escaped(c: Column) -> Column:
    text = F.replace(c, F.lit(ESCAPE), F.lit(ITSELF))
    text = F.replace(text, F.lit(SEPARATOR), F.lit(SEPARATED))
    text = F.when(F.is_valid_utf8(c), text).when(
        c.isNotNull(), F.concat(F.lit(BYTES), F.hex(c.cast("binary")))
    )
    return F.coalesce(text, F.lit(NULL))


def _plain(token: Column) -> Column:
    text = F.replace(token, F.lit(SEPARATED), F.lit(SEPARATOR))
    text = F.replace(text, F.lit(ITSELF), F.lit(ESCAPE))
    return F.when(
        token.startswith(BYTES), F.unhex(F.substring(token, 3, 2**31 - 1)).cast("string")
    ).otherwise(text)


def foldable(df: DataFrame, keep: Collection[str] = ()) -> list[StructField]:
    """The fields of ``df`` that can be folded, but for those in ``keep``."""
    return [f for f in df.schema if f.dataType in FOLDED and f.name not in keep]


def fold(df: DataFrame, into: str, fields: Sequence[StructField]) -> DataFrame:
    """``df`` with ``fields`` in the column ``into`` instead, after those that it holds already."""
    texts = [
        _escaped(F.col(f.name))
        if f.dataType == StringType()
        else F.coalesce(F.col(f.name).cast("string"), F.lit(NULL))
        for f in fields
    ]
    held = [F.col(into).cast("string")] if into in df.columns else []
    folded = F.concat_ws(SEPARATOR, *held, *texts).cast("binary")
    return df.withColumn(into, folded).drop(*[f.name for f in fields])


def unfold(df: DataFrame, folded: str, fields: Sequence[StructField]) -> DataFrame:
    """``df`` with ``fields``, which are all that were folded, instead of the column ``folded``."""
    tokens, plain = f"__{folded}_tokens", f"__{folded}_plain"
    whole = F.col(folded).cast("string")
    odd = whole.contains(ITSELF) | whole.contains(SEPARATED) | whole.contains(BYTES)
    values = {
        f.name: F.when(F.col(tokens)[place] != NULL, F.col(plain)[place]).cast(f.dataType)
        for place, f in enumerate(fields)
    }
    # The tokens are looked through only where the row has an escaped one.
    return (
        df.withColumn(tokens, F.split(whole, SEPARATOR))
        .withColumn(plain, F.when(odd, F.transform(tokens, _plain)).otherwise(F.col(tokens)))
        .withColumns(values)
        .drop(folded, tokens, plain)
    )

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from sluiceway.llm import sharding
from sluiceway.llm.catalogue import op12_sharding


def plain(rows, shards=16):
    """Brute force: sort, sum, cut at the middle of each row's bytes."""
    sized = []
    for doc_id, text in rows:
        raw = (text or "").encode("utf-8")
        sized.append((doc_id, len(raw) + (1 if text is not None else 1), zlib.crc32(raw)))
    sized.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[2], r[1]))
    total, before, out, first = sum(r[1] for r in sized), 0, [], {}
    for place, (doc_id, size, crc) in enumerate(sized):
        s = min(shards - 1, ((before * 2 + size) * shards) // (total * 2))
        first.setdefault(s, place)
        out.append((doc_id, size, crc, "bytes", s, place - first[s], None))
        before += size
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_plain_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(sharding.shard(docs)) == plain(rows)


def test_nulls_repeats_long_and_clashing(spark, docs, clashing):
    rows = [(3, "a"), (3, "a"), (None, "x"), (1, None), (2, ""), (5, "é" * 100_000), (4, "b c"), (3, "b")]
    frame = clashing(docs(*rows).withColumn("pos", F.lit(1)).withColumn("_p_uid", F.lit(2)))
    result = sharding.shard(frame.drop("_p_uid"), shards=4)
    assert got(result) == plain(rows, shards=4)
    slots = {}
    for r in result.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_bytes_near_equal(spark, docs):
    rows = [(i, "w" * (i % 97)) for i in range(3_000)]
    result = sharding.shard(docs(*rows), shards=16).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    total = sum(r.b for r in result)
    assert len(result) == 16 and all(abs(r.b - total / 16) <= 97 for r in result)


def test_empty_and_one(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(empty).count() == 0
    assert got(sharding.shard(docs((7, "abc")))) == [(7, 4, zlib.crc32(b"abc"), "bytes", 8, 0, None)]  # its middle halves the total


def test_query_reads_the_whole_table(spark, sf):
    assert op12_sharding(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()

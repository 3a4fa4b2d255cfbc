from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluiceway.llm import catalogue, simhash
from sluiceway.llm.components import connected_components


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] if len(words) >= k else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    """rows: (doc_id, fingerprint)."""
    groups = [{i} for i in range(len(rows))]
    of = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= radius and of[i] != of[j]:
            low, high = sorted((of[i], of[j]))
            for k in groups[high]:
                of[k] = low
            groups[low] |= groups[high]
    return [min((rows[k][0] for k in groups[of[i]] if rows[k][0] is not None), default=None) for i in range(len(rows))]


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "A\x0bb\x0cC d", "É é x y z", "a  b\tc\r\nd " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_set_of_places(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for places in itertools.combinations(range(0, 64, 1 if radius < 3 else 3), radius):
        bits = sum(1 << p for p in places)
        assert any(not m & bits for m in masks)


@pytest.mark.parametrize("bucket", [2048, 4])
def test_no_link_is_lost(spark, bucket):
    """Groups of near fingerprints, also when buckets have to be split."""
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            fps.add(base)
            base ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                base ^= 1 << rng.randrange(64)
    rows = [(k, fp) for k, fp in enumerate(sorted(fps))]
    signed = [int(np.uint64(fp).astype(np.int64)) for _, fp in rows]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(frame, 2, bucket)).collect()}
    mine = [roots.get(s, s) for s in signed]
    want = plain_components(rows)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, k) for k in range(1001, 1400)]
    rows = path + star + [(5, 5), (2000, None), (7, 6)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_odd_rows(docs, clashing):
    rows = docs((4, None), (3, ""), (9, " \n "), (None, "x y z"), (7, "x y z"), (8, "X y\tz"), (8, "x y z"), (5, "w " * 30_000))
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(clashing(rows)).collect()}
    assert got == {(4, 3), (3, 3), (9, 3), (None, 7), (7, 7), (8, 7), (5, 5)}
    assert simhash.near_duplicates(rows).count() == 8
    assert simhash.near_duplicates(rows.limit(0)).count() == 0
    assert simhash.near_duplicates(rows.where(F.col("doc_id").isNull())).first().component_id is None


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, plain_fingerprint(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(i, f"{fp:016x}", c) for (i, fp), c in zip(rows, plain_components(rows))}
    assert {tuple(r) for r in catalogue.op8_simhash(spark, sf).collect()} == want

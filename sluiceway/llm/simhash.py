"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit for each of 64 places: 1 if over half of the hashes of the
text's word shingles have it. Fingerprints that differ in at most ``radius`` bits are
linked. To find the links, every place gets a nonzero vector of ``radius + 1`` bits, and
each nonzero vector v of that length gives a mask of the places whose vector has an odd
product with v. For any ``radius`` places some v is orthogonal to all their vectors, so
two fingerprints within the radius agree on the whole of some mask (Pagh, "CoveringLSH",
2018): no pair is lost. A bucket with more than ``BUCKET`` distinct fingerprints is split
by the same construction over the places its mask leaves out, again and again; a
bucket's fingerprints differ only in those places, so the splitting ends.

Equal texts and equal fingerprints are one node. A bucket gives a star for each group
inside it, not its pairs, and ``components`` joins the stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once
from .common import lower_ascii, slices, texts
from .components import connected_components

BITS = 64
#: Distinct fingerprints that one task compares with each other.
BUCKET = 2048
SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned fingerprint of a whole text; 0 without a word."""
    words = lower_ascii(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())),
        np.uint64,
        len(starts),
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int, free: int = (1 << BITS) - 1, seed: int = 7) -> list[int]:
    """Masks within ``free`` such that any ``radius`` of its places lie outside one of them."""
    vectors = 2 ** (radius + 1) - 1
    places = [i for i in range(BITS) if free >> i & 1]
    order = np.random.default_rng(seed).permutation(len(places))
    vector = {place: 1 + int(order[k]) % vectors for k, place in enumerate(places)}
    masks = (
        sum(1 << i for i in places if (vector[i] & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    )
    return list(dict.fromkeys(masks))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _bucketed(fps: DataFrame, tree: list[list[int]], branch: Column) -> DataFrame:
    """``fp``, ``mask`` and ``key`` of the buckets with two or more fingerprints, with their number ``n``.

    ``tree[branch]`` lists the masks to use for a row.
    """
    masks = F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in tree])
    width = len(tree[0])
    exploded = fps.select("fp", branch.alias("branch"), F.posexplode(masks[branch]).alias("place", "bits"))
    return (
        exploded.select(
            "fp",
            (F.col("branch") * width + F.col("place")).alias("mask"),
            F.col("fp").bitwiseAND(F.col("bits")).alias("key"),
        )
        .withColumn("n", F.count("*").over(Window.partitionBy("mask", "key")))
        .where("n > 1")
    )


def _stars(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges from the fingerprints of a group of links to its least one."""
    bits = fps.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    waiting = np.ones(len(fps), dtype=bool)
    for first in np.argsort(fps):
        if not waiting[first]:
            continue
        group = near[first]
        while True:
            wider = near[group].any(axis=0)
            if wider.sum() == group.sum():
                break
            group = wider
        waiting &= ~group
        root = int(fps[first])
        yield from ((int(x), root) for x in fps[group] if x != root)


def _edges(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [e for fps in batch.column("fps") for e in _stars(fps.values.to_numpy(zero_copy_only=False), radius)]
            src, dst = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    gathered = buckets.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
    return gathered.mapInArrow(run, "src long, dst long").distinct()


def links(fps: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges ``src``, ``dst`` between distinct fingerprints, which connect all that lie within ``radius``.

    ``fps`` has distinct fingerprints in ``fp``.
    """
    full = (1 << BITS) - 1
    tree, branch, rest, found = [covering_masks(radius)], F.lit(0), fps, None
    while True:
        buckets = write_once(_bucketed(rest, tree, branch), "simhash")
        last = max(BITS - m.bit_count() for masks in tree for m in masks) <= bucket.bit_length() - 1
        small = buckets if last else buckets.where(F.col("n") <= bucket)
        edges = _edges(small, radius)
        found = edges if found is None else found.unionByName(edges)
        rest = buckets.where(F.col("n") > bucket)
        if last or rest.isEmpty():
            return found
        # Only places outside a mask can differ in its buckets.
        flat = [m for masks in tree for m in masks]
        subs = [covering_masks(radius, full & ~m, seed=k) for k, m in enumerate(flat)]
        width = max(map(len, subs))
        tree = [[m | s for s in sub] + [full] * (width - len(sub)) for m, sub in zip(flat, subs)]
        branch = F.col("mask").cast("int")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least ``doc_id`` reachable over links, for every row.

    Defined results: null and empty texts and texts of white space alone have the
    fingerprint 0 and are linked like others; a text of fewer words than a shingle is one
    shingle; a null id gives a row but is never the least, and the component is null if it
    has no other; repeated rows are rows of their own; an empty table gives no rows; other
    columns are ignored.
    """
    found = write_once(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = connected_components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    placed = nodes.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.join(placed.join(ids, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )

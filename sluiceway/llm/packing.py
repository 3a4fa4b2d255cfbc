"""Packing: best-fit decreasing over a histogram of lengths, for sequences of a fixed window.

Documents are tokenized, ended, and cut into full windows and one rest. Best-fit
decreasing needs only how many pieces there are of each length, at most ``window`` numbers
however large the corpus is. It takes the lengths downwards; a segment tree indexed by
remaining capacity finds the tightest open sequences that fit, and all pieces of one length
that go to sequences of one capacity are placed at once. The result is a table of ranges:
the pieces of this length from rank a to b go to the sequences from s on, at this offset.
Spark numbers the pieces of each length by counts per task and looks every piece up in it,
so the packing is that of one machine, without gathering the pieces anywhere.

Ids come from the ``tokenizers`` file. ``tiktoken`` reads the same vocabulary as ranks and
is about six times as fast, so texts made of characters for which both are known to
split alike go through it, and all others through ``tokenizers``.

Defined results: a null or empty text is the end id alone; repeated rows are packed each;
a null id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once
from .common import slices, texts

WINDOW = 2048
END_ID = 1
#: The vocabulary, as a file of ``tokenizers`` and as ranks for ``tiktoken``.
VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the vocabulary's one special token.
SPECIAL = {"<|endoftext|>": 50256}

#: Characters that both libraries put into the same classes whatever their Unicode version:
#: Latin, Greek, Cyrillic, and general punctuation. A test compares all of them.
_ALIKE = re.compile("[\x00-ʯͰ-ͷͺ-Ϳ΄-ΊΎ-ΡΣ-ԯ‐-‧‰-⁞]*")


class Encoder:
    """Ids of texts, as the ``tokenizers`` file gives them without added special tokens."""

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(vocabulary)
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                pairs = [line.split() for line in lines]
            self.fast = tiktoken.Encoding(
                "ranks",
                pat_str=public_tokenizers.PATTERN,
                mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
                special_tokens=SPECIAL,
            )

    def ids(self, text: str) -> list[int]:
        if self.fast and _ALIKE.fullmatch(text):
            return self.fast.encode(text, allowed_special="all")
        return self.slow.encode(text, add_special_tokens=False).ids


@functools.cache
def encoder(vocabulary: str, ranks: str | None) -> Encoder:
    """One for each Python worker."""
    return Encoder(vocabulary, ranks)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(
    docs: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of every document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``.

    ``part`` and ``rank`` number the pieces of one length within a task; write the result before
    reading them. ``ids`` has the piece's ids if ``keep_ids``. Without ``vocabulary`` the installed
    file is read, by both libraries.
    """
    files = (
        (vocabulary, ranks) if vocabulary else (public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS))
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"] + ["ids"] * keep_ids
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*files).ids
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in slices(batches, 256):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text), end_id], dtype=np.uint32)
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n = len(piece)
                    row = (doc, start, n, crc(piece), len(ids), part, int(seen[n]))
                    rows.append((*row, piece.tolist()) if keep_ids else row)
                    seen[n] += 1
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = ", ".join(f"{n} long" for n in names[:7]) + ", ids array<int>" * keep_ids
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


class Capacities:
    """A segment tree over remaining capacities: how many open sequences have each."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.tree[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity from ``least`` on that an open sequence has."""
        at = least + self.leaves
        while not self.tree[at]:
            # Up to the next subtree on the right.
            while at % 2:
                at //= 2
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first rank, end rank, first sequence, offset), given the pieces of each length.

    The packing is best-fit decreasing's: a piece goes to the fullest open sequence that
    holds it, and opens one only if none does.
    """
    open_ = Capacities(window)
    groups: dict[int, list[tuple[int, int]]] = {}  # by capacity: first sequence, number
    ranges, opened = [], 0

    def put(first: int, n: int, capacity: int) -> None:
        if n and capacity:
            groups.setdefault(capacity, []).append((first, n))
            open_.add(capacity, n)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = open_.tightest(length)
            if capacity is None:
                capacity = window
                each = window // length
                first, n = opened, -(-left // each)
                opened += n
            else:
                first, n = groups[capacity].pop()
                open_.add(capacity, -n)
                each = capacity // length
            # As many sequences as can be filled with `each` pieces, then one with what is left.
            full = min(n, left // each)
            for k in range(each if full else 0):
                ranges.append((length, rank, rank + full, first, window - capacity + k * length))
                rank += full
            left -= full * each
            put(first, full, capacity - each * length)
            first, n = first + full, n - full
            if n and left:
                some = min(left, each)
                for k in range(some):
                    ranges.append((length, rank, rank + 1, first, window - capacity + k * length))
                    rank += 1
                left -= some
                put(first, 1, capacity - some * length)
                first, n = first + 1, n - 1
            put(first, n, capacity)
    return ranges


def _placed(pieces: DataFrame, ranges: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, looked up by ``length`` and global rank in ``number``."""
    table = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 5)
    # At most a few ranges for each pair of length and capacity, so bounded by the window.
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    names = [c for c in pieces.columns if c not in ("part", "rank", "number")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, _, sequences, offsets = shared.value.T
        place = np.arange(len(lengths))
        begin = {int(n): (int(a), int(b) + 1) for n, a, b in (
            (n, place[lengths == n][0], place[lengths == n][-1]) for n in np.unique(lengths)
        )}
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                a, b = begin[int(n)]
                own = length == n
                at[own] = a + np.searchsorted(firsts[a:b], number[own], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(sequences[at] + number - firsts[at]), pa.array(offsets[at])],
                names=[*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in names)
    return pieces.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The written pieces of ``tokenized`` with the ``sequence_id`` and ``offset`` of each."""
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("number_before")
    )
    numbered = pieces.join(firsts, ["part", "length"]).withColumn("number", F.col("rank") + F.col("number_before"))
    return _placed(numbered.drop("number_before"), best_fit_decreasing(counts, window))


def packed(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = False, **options) -> DataFrame:
    """All documents in sequences of at most ``window`` tokens: one row for each piece."""
    pieces = write_once(tokenized(docs, window=window, end_id=end_id, keep_ids=keep_ids, **options), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pack(pieces, window).select(*columns, *["ids"] * keep_ids)

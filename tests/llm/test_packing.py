from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluiceway.llm import catalogue, packing

SLOW = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return SLOW.encode(text or "", add_special_tokens=False).ids + [1]


def test_both_libraries_agree_on_all_characters_of_the_fast_way():
    fast = packing.encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS)).fast
    known = [c for c in map(chr, range(0x2100)) if packing._ALIKE.fullmatch(c)]
    assert len(known) > 800
    texts = [f"a{c}b {c} {c}{c}1{c}'s  {c}\n" for c in known]
    assert [fast.encode(t, allowed_special="all") for t in texts] == [
        e.ids for e in SLOW.encode_batch(texts, add_special_tokens=False)
    ]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="ab '\ts\n1é<|endoftext>世", max_size=60))
def test_ids_of_any_text(text):
    own = packing.encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS))
    assert [*own.ids(text), 1] == plain_ids(text)


def test_ids_of_special_strings():
    own = packing.encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS))
    for text in ("<|endoftext|>", "a<|endoftext|>b", "<|endoftext|", "世<|endoftext|>"):
        assert [*own.ids(text), 1] == plain_ids(text)


def plain_packing(lengths, window):
    """Best-fit decreasing, one piece after the other."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            k = min(fits)[1]
            room[k] -= n
        else:
            room.append(window - n)
    return room


def check(ranges, counts, window):
    filled: dict = {}
    ranks: dict = {}
    for length, a, b, first, offset in ranges:
        for r in range(a, b):
            filled.setdefault(first + r - a, []).append((offset, length))
            ranks.setdefault(length, []).append(r)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    rooms = []
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        rooms.append(window - at)
    assert sorted(filled) == list(range(len(filled)))
    return rooms


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_histogram_packing_is_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    rooms = check(packing.best_fit_decreasing(counts, 40), counts, 40)
    assert sorted(rooms) == sorted(plain_packing(lengths, 40))


def test_many_pieces_take_few_ranges():
    rng = np.random.default_rng(1)
    counts = {n: int(c) for n, c in enumerate(rng.integers(1, 10**9, 2048), 1)}
    assert len(packing.best_fit_decreasing(counts, 2048)) < 300_000


def test_tightest():
    tree = packing.Capacities(2048)
    assert tree.tightest(1) is None
    for capacity in (5, 9, 2048):
        tree.add(capacity, 1)
    assert [tree.tightest(n) for n in (1, 5, 6, 10, 2048)] == [5, 5, 9, 2048, 2048]
    tree.add(9, -1)
    assert tree.tightest(6) == 2048


def verify(rows, docs, window=2048):
    by_doc: dict = {}
    for row in docs:
        by_doc.setdefault(row.doc_id, []).append(plain_ids(row.text))
    pieces = sorted((r.doc_id is None, r.doc_id or 0, r.start, r.ids_crc32, r.length, r.doc_tokens) for r in rows)
    want = sorted(
        (i is None, i or 0, s, zlib.crc32(np.array(ids[s : s + window], "<u4").tobytes()), len(ids[s : s + window]), len(ids))
        for i, copies in by_doc.items()
        for ids in copies
        for s in range(0, len(ids), window)
    )
    assert pieces == want
    placed: dict = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    tokens = sum(r.length for r in rows)
    return len(placed), -(-tokens // window)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_round_trip(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = catalogue.op4_packing(spark, folder).collect()
    used, least = verify(rows, spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert used <= least + 2


def test_odd_rows(spark, docs, clashing):
    rows = docs((1, None), (1, ""), (None, "a"), (2, "same text"), (2, "same text"), (3, "word " * 30_000), (4, "世界 ñ"))
    spread = clashing(rows).repartition(4)
    verify(packing.packed(spread).collect(), rows.collect())
    verify(packing.packed(spread, window=7).collect(), rows.collect(), 7)
    assert packing.packed(rows.limit(0)).count() == 0
    kept = packing.packed(rows, keep_ids=True).where("doc_id = 4").first()
    assert kept.ids == plain_ids("世界 ñ")

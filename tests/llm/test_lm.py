from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import catalogue, lm


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]


def plain(rows, held):
    """doc_id, held, n_tokens, n_known, train_tokens, base score of each row."""
    counts: Counter = Counter()
    for row in rows:
        if not held(row[0]):
            counts.update(tokens(row[1]))
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        words = tokens(text)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        yield i, held(i), len(words), sum(counts[w] > 0 for w in words), n, base


def by_crc(i):
    return zlib.crc32(str(i).encode()) % 10 == 0


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = catalogue.op9_lm(spark, folder).collect()
    compare(got, plain(rows, by_crc))
    held = [r for r in got if r.held_out]
    # Better than the unigram on texts it has not seen.
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)


@pytest.mark.parametrize(
    "block",
    [["A b  a"], [""], ["", " \n", "x"], [" lead", "trail ", "\x0b\x0cz"], ["É é e f"], ["a"] * 5 + ["b a"]],
)
def test_encoding(block):
    known, codes, lengths = lm.encoded_tokens(pa.array(block, pa.large_string()))
    want = [w for text in block for w in tokens(text)]
    assert [None if known[c] == lm.END else known[c].decode() for c in codes] == want
    assert lengths.tolist() == [len(tokens(t)) for t in block] and len(set(known)) == len(known)


def model(seed=0, distinct=900):
    """A trained model over random text, with head and rest."""
    rng = np.random.default_rng(seed)
    hashes = rng.integers(-(2**62), 2**62, distinct)
    totals = np.sort(np.minimum(rng.zipf(1.3, distinct), 500))[::-1].astype(np.int64)
    counts = lm.Counts(int(totals.sum()), distinct, hashes[: lm.HEAD], totals[: lm.HEAD])
    trainer = lm.Trainer(counts)
    head = counts.places(hashes)
    # A token is often followed by the next one, so that contexts tell something.
    codes = rng.choice(distinct, 5000, p=totals / totals.sum())
    codes[1::2] = (codes[::2] + 1) % distinct
    positions = lm.Positions(head, lm.slots_of(head, hashes), codes, np.array([3000, 2000]))
    for _ in range(5):
        trainer.step(positions.features, positions.target)
    return counts, trainer, positions, hashes, totals


def test_probabilities_of_all_tokens_and_one_unknown_sum_to_one():
    counts, own, positions, hashes, totals = model()
    for at in (0, 1, 2, 3000, 4321):
        features = np.repeat(positions.features[:, at : at + 1], len(hashes) + 1, axis=1)
        every = lm.Positions.__new__(lm.Positions)
        every.features = features
        every.target = np.append(counts.places(hashes), -1)
        p = 10 ** own.log_probability(every, counts.log_rest(np.append(totals, 0)))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_gradient_steps_raise_the_likelihood():
    counts, own, positions, hashes, totals = model()
    rest = np.zeros(len(positions))
    fresh = lm.Model(counts, lm.Weights())
    assert own.log_probability(positions, rest).sum() > fresh.log_probability(positions, rest).sum() + 100


def test_contexts_stay_within_a_text():
    counts, _, _, hashes, _ = model()
    head = counts.places(hashes)
    slots = lm.slots_of(head, hashes)
    two = lm.Positions(head, slots, np.array([5, 6, 7, 8, 9]), np.array([3, 2]))
    one = lm.Positions(head, slots, np.array([8, 9]), np.array([2]))
    assert (two.features[:, 3:] == one.features).all()


def test_spans_hold_whole_texts(monkeypatch):
    monkeypatch.setattr(lm, "SPAN_TOKENS", 10)
    lengths = np.array([3, 4, 5, 30, 1, 1])
    got = [(d.start, d.stop, t.start, t.stop) for d, t in lm.spans(lengths)]
    assert got == [(0, 2, 0, 7), (2, 3, 7, 12), (3, 4, 12, 42), (4, 6, 42, 44)]


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows_and_many_blocks(spark, docs, clashing, monkeypatch, small):
    if small:  # many blocks, tasks and levels of mixing
        for name, value in {"BLOCK_CHARS": 40, "SPAN_TOKENS": 5, "TASK_TOKENS": 3000, "MIXED": 2}.items():
            monkeypatch.setattr(lm, name, value)
    texts = [(1, None), (1, ""), (None, "a b"), (2, "A b\tc " * 20), (2, "A b\tc " * 20), (3, "unseen w" + "x" * 5000)]
    texts += [(k, "the cat sat on the mat " * (k % 5)) for k in range(10, 90)] + [(4, "z " * 8000)]
    rows = docs(*texts)

    def held(i):
        return i is not None and i % 3 == 0

    got = lm.score(clashing(rows.repartition(6)), F.col("doc_id") % 3 == 0)
    compare(got.collect(), plain(texts, held))
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got.collect())
    assert lm.score(rows.limit(0), F.lit(False)).count() == 0


def test_without_training_tokens_everything_is_certain(spark, docs):
    got = lm.score(docs((1, "a b"), (2, None)), F.lit(True)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert all(r.score == pytest.approx(0, abs=1e-9) for r in got)


def test_contexts_tell_tokens_beyond_the_head_apart():
    """Every training token takes part, is told from others by its context, and all sum to one."""
    rng, distinct = np.random.default_rng(2), 3000
    hashes = rng.integers(-(2**62), 2**62, distinct)
    totals = np.sort(np.minimum(rng.zipf(1.3, distinct), 500))[::-1].astype(np.int64)
    levels, many = np.unique(-totals[lm.HEAD :], return_counts=True)
    counts = lm.Counts(int(totals.sum()), distinct, hashes[: lm.HEAD], totals[: lm.HEAD], lm.Ladder(-levels, many))
    hashes, ranks = np.append(hashes, 77), np.append(np.arange(distinct), -1)  # and one unknown
    head = counts.places(hashes)
    slots = lm.slots_of(head, hashes, counts.slots)
    # Tokens 2000 and 2001, of one count, each after one of the head and in the end after each other's.
    codes = np.tile([5, 2000, 9, 2001], 400)
    codes[-4:] = [5, 2001, 9, 2000]

    def of(codes):
        return lm.Positions(head, slots, codes, np.array([len(codes)]), counts, ranks)

    positions, trainer = of(codes), lm.Trainer(counts)
    fresh = trainer.log_within_rest(positions, np.array([1]))[0]
    assert fresh == pytest.approx(counts.log_rest(totals[2000:2001])[0], abs=1e-4)
    for _ in range(5):
        trainer.step(positions.features[:, :-4], positions.target[:-4])
        trainer.step_rest(positions, np.flatnonzero(positions.target[:-4] < 0))
    p = trainer.log_probability(positions, np.zeros(len(positions)))
    assert p[1589] > p[1597] + 1 and p[1591] > p[1599] + 1
    every = of(np.arange(distinct + 1))
    every.features = np.repeat(positions.features[:, 1:2], distinct + 1, axis=1)
    every.contexts = np.repeat(positions.contexts[:, 1:2], distinct + 1, axis=1)
    assert (10 ** trainer.log_probability(every, np.zeros(distinct + 1))).sum() == pytest.approx(1, abs=1e-4)


def test_counts_travel_as_one_row_for_each_block_and_slice(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_CHARS", 30_000)
    texts = [(k, " ".join(f"w{j}" for j in range(k % 3, 4000, 1 + k % 3))) for k in range(4)]
    encoded = lm.blocks(docs(*texts).coalesce(1), F.col("doc_id") == 3).cache()
    rows = lm.counted(encoded).cache()
    many = encoded.count()
    assert many > 1 and rows.count() <= (many + 1) * lm.SLICES
    want: Counter = Counter()
    for k, text in texts[:3]:
        want.update(tokens(text))
    got = lm.count_summary(rows)
    assert (got.tokens, got.distinct) == (sum(want.values()), len(want))
    assert got.head_counts.tolist() == sorted(want.values(), reverse=True)[: lm.HEAD]
    # Each token's rank gives its count, and no two tokens have one rank.
    ranks = {}
    for block, opened in zip(encoded.orderBy("block").collect(), lm._ranked(encoded, rows, got).orderBy("block").collect()):
        hashes = np.empty(len(block.hashes) // 8, np.int64)
        hashes[lm.from_planes(block.order, "<i4")] = np.frombuffer(block.hashes, "<i8")
        ranks |= dict(zip(hashes.tolist(), lm.from_planes(opened.ranks, "<i8").tolist()))
    own = {lm.xxhash.xxh64_intdigest(w.encode() if w else lm.END): n for w, n in want.items()}
    known = {h % 2**64: r for h, r in ranks.items() if r >= 0}
    assert sorted(known.values()) == list(range(len(want)))
    places = np.array([known[h] for h in own])
    assert got.totals(places).tolist() == list(own.values())


def test_models_are_half_precision_rows_of_parts_that_were_met():
    counts, own, *_ = model()
    rows = [lm._model_row(0, *part) for part in own.parts()]
    assert 0 < sum(r.nbytes for r in rows) < 2.5 * sum(len(w) for _, w, _ in own.parts())
    assert len(rows) < len(own.weights.parts())
    back = lm.Weights(counts.slots, counts.tree_weights)
    parts = back.parts()
    for row in rows:
        parts[row["part"][0].as_py()][:] = np.frombuffer(row["weights"][0].as_py(), np.float16)
    for name in ("classes", "words", "tree"):
        assert np.allclose(getattr(back, name), getattr(own.weights, name), rtol=1e-3, atol=1e-6)


def test_score_agrees_with_a_plain_tree():
    """The probabilities within the rest against one softmax after another, turn by turn."""
    rng, totals = np.random.default_rng(3), np.sort(np.random.default_rng(4).integers(1, 40, 700))[::-1]
    levels, many = np.unique(-totals[lm.HEAD :], return_counts=True)
    counts = lm.Counts(int(totals.sum()), len(totals), np.arange(lm.HEAD), totals[: lm.HEAD], lm.Ladder(-levels, many))
    ranks = np.arange(len(totals))
    head = counts.places(ranks)
    codes = rng.integers(lm.HEAD, len(totals), 60)
    positions = lm.Positions(head, lm.slots_of(head, ranks), codes, np.array([40, 20]), counts, ranks)
    weights = lm.Weights(counts.slots, counts.tree_weights)
    weights.tree[:] = rng.normal(0, 0.5, weights.tree.shape)
    got = lm.Model(counts, weights).log_within_rest(positions, np.arange(60))
    each = np.append(totals[lm.HEAD :], 0) + 0.1
    for at, code in enumerate(codes):
        low, high, depth, want = 0, len(each), 1, 0.0
        while high - low > 1:
            cuts = counts.ladder.cuts(np.array([low]), np.array([high]))[0]
            assert (np.diff(cuts) >= (high - low >= lm.WAYS)).all()
            name = (low * 64 + depth) * 0x9E3779B97F4A7C15 % 2**64
            logits = np.array([math.log(s) if (s := each[a:b].sum()) else -80 for a, b in zip(cuts[:-1], cuts[1:])])
            for context in positions.contexts[:, at]:
                mixed = (int(context) ^ name) * 0xFF51AFD7ED558CCD % 2**64
                logits += weights.tree[mixed >> (65 - len(weights.tree).bit_length())]
            child = int(np.searchsorted(cuts[1:-1], code - lm.HEAD, side="right"))
            live = np.diff(cuts) > 0
            want += math.log10(math.exp(logits[child]) / np.exp(logits[live]).sum())
            low, high, depth = int(cuts[child]), int(cuts[child + 1]), depth + 1
        assert got[at] == pytest.approx(want, abs=1e-4)

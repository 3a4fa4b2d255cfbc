from __future__ import annotations

import random
import re
import zlib

from sluiceway.llm import variants
from sluiceway.llm.catalogue import op13_variants

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def plain(rows, least=7, ratio=10):
    """Brute force: every pair of words compared."""
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(ASCII)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 31 == 0:
                    k = h % len(low)
                    low = low[:k] + low[k + 1 :]
            counts[low] = counts.get(low, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        f = form[w]
        out.append((w, f, root, words[w], len(near[w]), words[f] if f else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_choose_pivots_are_disjoint_and_in_prefix():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(7, 14)))
        grams = [(rng.randint(1, 5), word[i : i + 2], i) for i in range(len(word) - 1)]
        prefix, pivots = variants.choose(grams)
        assert len(pivots) == 2 and all(p in prefix for p in pivots) and abs(pivots[0][2] - pivots[1][2]) >= 2
        assert len(prefix) >= 3


def test_against_brute_force(spark, docs):
    rng = random.Random(7)
    base = ["abcdefgh", "elephant", "Ordinateur", "éléphantine", "aaaaaaaaa", "transmission"]
    rows = []
    for i in range(1, 1500):
        words = []
        for _ in range(rng.randint(0, 12)):
            w = rng.choice(base)
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice("xyzÀ") + w[k + 1 :]
            words.append(w)
        rows.append((i, " ".join(words) + ("" if i % 9 else "-x!abcdefghZ")))
    rows += [(None, "elephant elephant elephnt"), (3, None), (4, ""), (5, "a" * 30_000 + " " + "a" * 30_000)]
    assert got(variants.variants(docs(*rows))) == plain(rows)


def test_words_that_share_a_bigram_are_not_all_compared(spark):
    rng = random.Random(5)
    words = {"qx" + "".join(rng.choice("abc") for _ in range(9)) for _ in range(600)}
    words = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    listed = [r.word for r in words.collect()]
    expected = {(a, b) for a in listed for b in listed if one_edit(a, b)}
    assert {tuple(r) for r in variants.near_pairs(words).collect()} == expected
    joined = [0]
    real = variants.candidates

    def counted(signed):
        found = real(signed)
        joined[0] = found.count()
        return found

    variants.candidates = counted
    try:
        variants.near_pairs(words).count()
    finally:
        variants.candidates = real
    # All share the bigram at their start, its place and their length: some 600 ** 2 pairs.
    assert len(expected) <= joined[0] < len(listed) ** 2 / 20


def test_random_words_of_every_length(spark):
    """Insertions, deletions and replacements at every place, the middle and the ends among them."""
    rng = random.Random(11)
    words = set()
    for size in [*range(7, 14)] * 4 + [variants.LONG - 1, variants.LONG, variants.LONG + 1]:
        w = "".join(rng.choice("abcdé") for _ in range(size))
        words.add(w)
        for k in range(len(w) + 1):
            words |= {w[:k] + "z" + w[k:], w[:k] + w[k + 1 :], w[:k] + "y" + w[k + 1 :]}
    listed = sorted(w for w in words if len(w) >= 7)
    table = spark.createDataFrame([(w, 2) for w in listed], "word string, n long")
    expected = {(a, b) for a in listed for b in listed if one_edit(a, b)}
    assert {tuple(r) for r in variants.near_pairs(table).collect()} == expected


def test_chain_of_forms(spark, docs):
    rows = [(i, "abcdefghij") for i in range(1, 201)] + [(i, "abcdefghi") for i in range(201, 221)]
    rows += [(i, "abcdefgh") for i in range(221, 223)]
    assert got(variants.variants(docs(*rows))) == plain(rows)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(empty).count() == 0


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op13_variants(spark, sf)) == plain(rows)

"""Spelling variants: words one edit apart, each pointed at a far more frequent near word.

Words are the maximal runs of letters (A-Z, a-z and U+00C0 to U+00FF) of whole texts, with
only A-Z lower-cased; a run whose crc32 of ``<doc_id>:<run>`` is divisible by 31 loses the
code point at that crc32 modulo its length (a planted misspelling). Counted over all texts,
words of at least ``least_length`` code points that occur at least twice take part. Two are
near when one inserted, deleted or replaced code point turns one into the other. A word's
form is its near word of largest count (ties: smallest in code-point order) when that count
is at least ``ratio`` times its own; its root follows forms to the end.

Method: pivotal prefix filtering on bigrams (Deng, Li and Feng, SIGMOD 2014). Bigrams are
ranked by how often they occur in the words, rarest first; this table has at most 90^2 rows (the
alphabet is fixed), so it is broadcast. A word's prefix is its first ``q * tau + 1`` positional
bigrams in that order (with every gram tied to the last); its pivots are ``tau + 1`` disjoint
bigrams of the prefix of least total frequency, chosen by dynamic programming. If two words
are within ``tau`` edits and the last prefix bigram of ``a`` comes no later in the order than
that of ``b``, a pivot of ``a`` lies in ``b``'s prefix, at the same place if their lengths are
equal, else there or one place on; pairs are sought from both sides, as one of the two does. Pivots are joined with prefixes on (bigram, place, rest),
folded into one 64-bit hash: the rest is the word as it is and without each code point outside the
bigram, as a word one edit away has one of these too (with the same place in it). Words of
``LONG`` code points and more have many places, so for them the rest is a half of ``b``, one of
which the edit leaves as it is, at the lemma's place by length. Every candidate is verified by a
banded edit distance, so clashing hashes add no pair. No pair is lost and no group of a bigram
and place is compared with itself in full.

Forms only point to words with at least ``ratio`` times the count, so chains are shorter than
log base ``ratio`` of the largest count; roots are found by pointer doubling, as many joins as
the largest count needs.

Defined results: null or empty texts give no words; a null ``doc_id`` gives no crc32, so its
runs are kept as they are; repeated rows count again; very long runs are words like any other;
ties go to the smaller word; an empty table or one without words gives no rows; other columns
of ``docs`` are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Q = 2  # bigrams
TAU = 1  # one edit
LONG = 32  # words up to this length are joined without a code point, those from it by halves
LEFT, RIGHT = 0, 1  # halves of a word


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run of letters: its word after the planted deletion."""
    runs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), 0)).alias("run"),
    )
    lowered = F.translate("run", UPPER, LOWER)
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), lowered).cast("binary"))
    at = (h % F.length(lowered)).cast("int")
    cut = F.concat(lowered.substr(F.lit(1), at), lowered.substr(at + 2, F.length(lowered)))
    return runs.select(F.when(h % 31 == 0, cut).otherwise(lowered).alias("word"))


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """word, n: counts combine in each task before the shuffle."""
    counted = occurrences(docs).filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def choose(grams: list[tuple[int, str, int]], q: int = Q, tau: int = TAU) -> tuple[list, list]:
    """Prefix and pivots of one word from its (frequency, bigram, place) triples.

    The prefix holds the first ``q * tau + 1`` by (frequency, bigram) and every one tied with the
    last; pivots are ``tau + 1`` of them at places ``q`` or more apart, of least total frequency.
    """
    ranked = sorted(grams)
    need = q * tau + 1
    edge = ranked[min(need, len(ranked)) - 1][:2]
    prefix = [g for g in ranked if g[:2] <= edge]
    by_place = sorted(prefix, key=lambda g: g[2])
    k = tau + 1
    inf = float("inf")
    # best[i][c]: least cost of c pivots among the first i of by_place; back pointers rebuild it
    best = [[0.0] + [inf] * k for _ in range(len(by_place) + 1)]
    take = [[False] * (k + 1) for _ in range(len(by_place) + 1)]
    earlier = []
    for i, g in enumerate(by_place):
        j = i
        while j > 0 and by_place[j - 1][2] > g[2] - q:
            j -= 1
        earlier.append(j)
    for i in range(1, len(by_place) + 1):
        for c in range(1, k + 1):
            skip, use = best[i - 1][c], by_place[i - 1][0] + best[earlier[i - 1]][c - 1]
            best[i][c], take[i][c] = (use, True) if use < skip else (skip, False)
    pivots, i, c = [], len(by_place), k
    while c > 0 and i > 0:
        if take[i][c]:
            pivots.append(by_place[i - 1])
            i, c = earlier[i - 1], c - 1
        else:
            i -= 1
    return prefix, pivots[::-1]


def _signatures(freq: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"id": [], "word": [], "role": [], "gram": [], "pos": [], "len": []}
            for number, word in zip(batch["id"], batch["word"]):
                grams = [(freq[word[i : i + Q]], word[i : i + Q], i) for i in range(len(word) - Q + 1)]
                prefix, pivots = choose(grams)
                for role, chosen in ((0, pivots), (1, prefix)):
                    for _, gram, pos in chosen:
                        out["id"].append(number)
                        out["word"].append(word)
                        out["role"].append(role)
                        out["gram"].append(gram)
                        out["pos"].append(pos)
                        out["len"].append(len(word))
            yield pd.DataFrame(out).astype({"id": "int64", "role": "int32", "pos": "int32", "len": "int32"})

    return run


def candidates(signed: DataFrame) -> DataFrame:
    """(a, b), numbers of words, where a pivot of ``a`` lies in the prefix of ``b`` and the rest of both can be one edit apart."""
    short, long_ = signed.filter(F.col("len") <= LONG), signed.filter(F.col("len") >= LONG)
    pivots, prefixes = (_deleted(short.filter(F.col("role") == role)) for role in (0, 1))
    sought = _with_keys(long_.filter("role = 0"), *_sought())
    half = F.floor(F.col("len") / 2).cast("int")
    kept = _with_keys(
        long_.filter("role = 1"),
        _key(F.col("pos"), F.col("len"), LEFT, F.col("word").substr(F.lit(1), half)),
        _key(F.col("pos"), F.col("len"), RIGHT, F.col("word").substr(half + 1, F.col("len"))),
    )
    pivots = pivots.unionByName(sought).withColumnRenamed("id", "a")
    prefixes = prefixes.unionByName(kept).withColumnRenamed("id", "b")
    return pivots.join(prefixes, "key").filter(F.col("a") != F.col("b")).select("a", "b")


def _with_keys(signed: DataFrame, *keys: Column) -> DataFrame:
    return signed.select("id", F.explode(F.array(*keys)).alias("key")).filter(F.col("key").isNotNull())


def _deleted(signed: DataFrame) -> DataFrame:
    """``id``, ``key``: a bigram, its place and the word, as it is (cut -1) and without each code point outside the bigram."""
    cut, pos, word = F.col("cut"), F.col("pos"), F.col("word")
    rows = signed.select("id", "word", "gram", "pos", F.explode(F.sequence(F.lit(-1), F.col("len") - 1)).alias("cut"))
    outside = rows.filter((cut < pos) | (cut >= pos + Q))
    left = F.when(cut < 0, word).otherwise(F.concat(word.substr(F.lit(1), cut), word.substr(cut + 2, F.length(word))))
    moved = pos - F.when((cut >= 0) & (cut < pos), 1).otherwise(0)
    return outside.select("id", F.xxhash64("gram", moved, left).alias("key"))


def _key(pos: Column, length: Column, side: int, half: Column) -> Column:
    return F.xxhash64("gram", pos, length, F.lit(side), half)


def _sought() -> list[Column]:
    """Keys of the words one edit from ``word`` that keep its pivot and a half of their own; null where that cannot be.

    The pivot lies at the same place if the lengths are equal; if the other word is one longer (an
    insertion) or shorter (a deletion), there when the edit comes after it, else one place on.
    """
    keys = []
    for longer in (0, 1, -1):
        length = F.col("len") + longer
        half = F.floor(length / 2).cast("int")
        left = F.col("word").substr(F.lit(1), half)
        right = F.col("word").substr(F.col("len") - length + half + 1, F.col("len"))
        for moved in {0, longer}:
            pos = F.col("pos") + moved
            # An edit behind the left half comes before a pivot only if that lies there too; one
            # before the right half comes after a pivot only if that ends before it.
            in_left, in_right = F.lit(moved == 0) | (pos >= half), F.lit(moved == longer) | (pos < half - 1)
            keys.append(F.when(in_left, _key(pos, length, LEFT, left)))
            keys.append(F.when(in_right, _key(pos, length, RIGHT, right)))
    return keys


def near_pairs(words: DataFrame, run: str = "") -> DataFrame:
    """(a, b) for every ordered pair of words one edit apart."""
    grams = words.select("word", F.posexplode(F.transform(F.sequence(F.lit(0), F.length("word") - Q), lambda i: F.col("word").substr(i + 1, F.lit(Q)))))
    # at most 90 ** 2 bigrams: the alphabet bounds this table
    freq = {r["col"]: r["count"] for r in grams.groupBy("col").count().collect()}
    # Words are joined by number, however long they are.
    numbered = write_once(words.select(F.monotonically_increasing_id().alias("id"), "word"), "variant-numbers", run)
    schema = "id long, word string, role int, gram string, pos int, len int"
    signed = write_once(numbered.mapInPandas(_signatures(freq), schema), "variant-signatures", run)
    pairs = candidates(signed).select(F.least("a", "b").alias("ia"), F.greatest("a", "b").alias("ib")).distinct()
    named = [numbered.select(F.col("id").alias(f"i{x}"), F.col("word").alias(x)) for x in "ab"]
    near = pairs.join(named[0], "ia").join(named[1], "ib").filter(F.levenshtein("a", "b", TAU) == TAU)
    return near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, run: str = "") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``."""
    words = write_once(vocabulary(docs, least_length, least_count), "variant-words", run)
    near = near_pairs(words, run)
    counted = near.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    best = counted.groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("neg"), F.col("b").alias("b"))).alias("best")
    )
    own = words.join(best, words["word"] == best["a"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.neg")).alias("top_n"), F.col("best.b").alias("top")
    )
    formed = own.select(
        "word", "n", "n_near",
        F.when(F.col("top_n") >= F.col("n") * ratio, F.col("top")).alias("form"),
        F.when(F.col("top_n") >= F.col("n") * ratio, F.col("top_n")).alias("form_n"),
    )
    formed = write_once(formed, "variant-forms", run)
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log2(math.log(max(most, 2), ratio) + 2)))
    jump = formed.select("word", F.coalesce("form", "word").alias("to"))
    for _ in range(steps):
        ahead = jump.select(F.col("word").alias("via"), F.col("to").alias("next"))
        jump = write_once(jump.join(ahead, jump["to"] == ahead["via"]).select("word", F.col("next").alias("to")), "variant-roots", run)
    return formed.join(jump, "word").select("word", "form", F.col("to").alias("root"), "n", "n_near", "form_n")


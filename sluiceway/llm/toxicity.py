"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs
that stand for letters to one form, drops invisible characters and turns all else
into blanks. The lexicon (whole words and beginnings of words) and its weights are
learned from labelled documents as log odds of how many documents of either label
have the term. Exception phrases, given or learned as pairs of words that only
clean documents show, cancel the matches inside them. A document's weight and its
weight per length go through a logistic curve that is fitted on the same sample.

The fit uses at most ``sample_rows`` labelled documents, chosen by a hash of the id
(a documented bound); near copies in it, which share the least or the greatest hash of
their word triples, count once, so that a group of copies cannot lift its words into the
lexicon. Scoring covers every whole text in one pass without a shuffle.

Defined results: null and empty texts have weight 0; without labels, or without a
term that tells the labels apart, every score is the share of label 1, or 0.05;
repeated rows each give a row; columns other than id and text are never read.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once
from .common import remainder, slices, texts

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(
    zip(
        "авекмнорстухіјѕԁɡһαβεικνορτυχıɑոսℓ",
        "abekmhopctyxijsdghabeikvoptuxianul",
        strict=True,
    )
)
#: Digits and signs that stand for letters. l joins i, as 1 stands for both.
STAND_INS = dict(zip("013457@$l", "oieastasi", strict=True))
#: Characters without a width.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Phrases in which words of abuse are harmless.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "soap scum", "idiot proof")

PREFIX_LENGTHS = (4, 5, 6)


class _Fold(dict):
    """Characters as they are met; str.translate asks for each once."""

    def __missing__(self, code: int) -> str:
        low = unicodedata.normalize("NFKC", chr(code)).lower()
        if chr(code) in INVISIBLE or unicodedata.category(chr(code)) == "Mn":
            out = ""
        else:
            out = "".join(STAND_INS.get(c, c) for c in (LOOK_ALIKES.get(c, c) for c in low))
            if not all(c.isalnum() for c in out):
                out = " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded words, one blank between and around them."""
    return f" {' '.join(text.translate(_FOLD).split())} "


@dataclass(frozen=True)
class Lexicon:
    """``terms``: pattern (with a blank before, and after if a whole word) to weight."""

    terms: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float
    slopes: tuple[float, float]

    def automaton(self):
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            if phrase.strip():
                found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def weigh(automaton, text: str) -> float:
    """The summed weight of the matched words; a word counts once, by its heaviest term."""
    if not len(automaton):
        return 0.0
    best: dict[int, float] = {}
    safe = []
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if weight is None:
            safe.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if safe and best:
        best = {at: w for at, w in best.items() if not any(s <= at < e for s, e in safe)}
    return sum(best.values())


def measures(weight: float, words: int) -> tuple[float, float]:
    """What the logistic curve sees: the weight, and the weight per hundred words."""
    return math.log1p(weight), math.log1p(100.0 * weight / max(words, 1))


def _features(folded: str) -> set[str]:
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIX_LENGTHS if len(w) >= n}


def _sketch(folded: str) -> tuple[int, int]:
    """The least and the greatest hash of the word triples."""
    w = folded.split()
    shingles = zip(w, w[1:], w[2:]) if len(w) > 2 else [w]
    hashes = [xxhash.xxh64_intdigest(" ".join(s)) - 2**63 for s in shingles]
    return min(hashes), max(hashes)


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """At most about ``rows`` labelled documents, one for each group of near copies: toxic, folded."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(
        F.max(F.col(label_col).cast("int")).alias("toxic")
    )
    known = known.where(remainder("doc_id", 4) != 2)
    total = known.count()
    grid = 1 << 20
    if total > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < int(grid * rows / total))
    chosen = texts(docs).where(F.col("doc_id").isNotNull()).join(known, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            folded = [fold(t) for t in batch.column("text").to_pylist()]
            low, high = zip(*map(_sketch, folded)) if folded else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array(folded, pa.string()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                ],
                names=["doc_id", "toxic", "folded", "low", "high"],
            )

    kinds = "doc_id long, toxic int, folded string, low long, high long"
    found = write_once(chosen.mapInArrow(run, kinds), "toxicity")
    for sketch in ("low", "high"):
        first = found.groupBy(sketch, "toxic").agg(F.min("doc_id").alias("doc_id"))
        found = found.join(first, [sketch, "toxic", "doc_id"]).dropDuplicates([sketch, "toxic"])
    return found


def _counted(batches: Iterator[pa.RecordBatch], of) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have a feature, summed over what a task reads."""
    counts = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("folded").to_pylist()):
            counts[toxic].update(of(text))
        if sum(map(len, counts)) > 100_000:
            yield _as_rows(counts)
            counts = (Counter(), Counter())
    yield _as_rows(counts)


def _as_rows(counts) -> pa.RecordBatch:
    terms = list(counts[0].keys() | counts[1].keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string())] + [pa.array([c[t] for t in terms], pa.int64()) for c in counts],
        names=["term", "clean", "toxic"],
    )


def _tally(sample: DataFrame, of) -> DataFrame:
    def run(batches):
        yield from _counted(batches, of)

    counted = sample.select("toxic", "folded").mapInArrow(run, "term string, clean long, toxic long")
    return counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _neighbours(automaton, text: str) -> set[str]:
    """Pairs of words around each match."""
    found = set()
    for end, (length, _) in automaton.iter(text):
        at = end - length + 1
        stop = text.find(" ", at + 1)
        after = text.find(" ", stop + 1)
        before = text.rfind(" ", 0, at)
        if after > 0:
            found.add(text[at : after + 1])
        if before >= 0:
            found.add(text[before : stop + 1])
    return found


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a logistic regression with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (p - y) + ridge * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    sample_rows: int = 20_000,
    size: int = 4096,
    least_docs: int = 5,
    least_odds: float = 4.0,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """Learn a lexicon of at most ``size`` terms from the labels whose remainder modulo 4 is not 2.

    A term needs ``least_docs`` documents of label 1 and a log odds of ``least_odds``
    against those of label 0. ``sample_rows`` bounds the labelled documents used.
    """
    sample = write_once(_sample(docs, labels, label_col, sample_rows), "toxicity-sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    plain = tuple(fold(e) for e in exceptions)
    if not toxic or not clean:
        share = min(max(toxic / max(1, toxic + clean), 0.05), 0.95)
        return Lexicon({}, plain, math.log(share / (1 - share)), (0.0, 0.0))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    kept = (
        _tally(sample, _features)
        .withColumn("weight", odds)
        .where((F.col("toxic") >= least_docs) & (F.col("weight") >= least_odds))
        .orderBy(F.desc(F.col("weight") * F.log1p(F.col("toxic"))), "term")
        .limit(size)
        .collect()
    )
    lexicon = Lexicon({r.term: r.weight for r in kept}, (), 0.0, (0.0, 0.0))
    if lexicon.terms:
        # Pairs around a term that clean documents show and toxic ones do not.
        def pairs(text, own={}):  # noqa: B006  one automaton for each worker's task
            if "a" not in own:
                own["a"] = lexicon.automaton()
            return _neighbours(own["a"], text)

        learned = (
            _tally(sample, pairs)
            .where((F.col("clean") >= 3) & (F.col("clean") * toxic >= 20 * F.col("toxic") * clean))
            .orderBy(F.desc("clean"), "term")
            .limit(size)
            .collect()
        )
        plain += tuple(r.term for r in learned)
    lexicon = Lexicon(lexicon.terms, plain, 0.0, (0.0, 0.0))
    seen = _weighed(sample.select("folded", "toxic"), lexicon).select("weight", "words", "toxic").collect()
    x = np.array([measures(r.weight, r.words) for r in seen])
    beta = _logistic(x, np.array([r.toxic for r in seen], dtype=float))
    return Lexicon(lexicon.terms, plain, float(beta[0]), (float(beta[1]), float(beta[2])))


def _weighed(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            folded = batch.column("folded").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([weigh(automaton, t) for t in folded], pa.float64()),
                    pa.array([max(0, t.count(" ") - 1) for t in folded], pa.int64()),
                    batch.column("toxic"),
                ],
                names=["weight", "words", "toxic"],
            )

    return sample.mapInArrow(run, "weight double, words long, toxic int")


def probability(lexicon: Lexicon, weight: float, words: int) -> float:
    a, b = measures(weight, words)
    z = lexicon.bias + lexicon.slopes[0] * a + lexicon.slopes[1] * b
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) as last columns.

    Columns of these names that ``docs`` already has are replaced.
    """
    docs = docs.drop("score", "predicted")
    place = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in slices(batches, 1000):
            scores = []
            for text in batch.column(place).to_pylist():
                folded = fold(text or "")
                scores.append(probability(lexicon, weigh(automaton, folded), max(0, folded.count(" ") - 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                ],
                names=[*batch.schema.names, "score", "predicted"],
            )

    return docs.mapInArrow(run, f"{fields}, score double, predicted int")
